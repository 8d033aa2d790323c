"""The feature matrix: contract, time, and provider features, then flags and codes, as one plan.

Raw features come first; thresholds and codes are fitted on them (on a training part, if given) and
applied once, so nothing depends on its own output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RuleSet
from ..functions import dates, identity, money, text
from . import bids, dedupe, encoding, flags, history, thresholds

# --- fixed values: feature names in the order that models and artifacts have them ---
CATEGORY_A = ("departamento_cat", "es_contratacion_directa", "es_regimen_especial", "es_servicios_profesionales", "modalidad_contratacion_cat", "origen_recursos_cat", "tiene_justificacion_modalidad", "tipo_contrato_cat", "unspsc_categoria", "valor_contrato")
CATEGORY_B = ("dias_a_proxima_eleccion", "dias_decision", "dias_firma_a_inicio", "dias_proveedor_registrado", "dias_publicidad", "duracion_contrato_dias", "firma_posterior_a_inicio", "mes_firma", "trimestre_firma")
CATEGORY_C = ("num_actividades_economicas", "num_contratos_previos_depto", "num_contratos_previos_nacional", "num_ofertas_recibidas", "num_proponentes", "num_retrasos_previos", "num_sobrecostos_previos", "proponente_unico", "tipo_persona_proveedor", "valor_total_contratos_previos_depto", "valor_total_contratos_previos_nacional")
CATEGORY_D = ("iric_anomalias", "iric_competencia", "iric_score", "iric_transparencia", "ausencia_proceso", "contratacion_directa", "datos_faltantes", "historial_proveedor_alto", "periodo_decision_extremo", "periodo_publicidad_extremo", "proveedor_multiproposito", "proveedor_retrasos_previos", "proveedor_sobrecostos_previos", "regimen_especial", "unico_proponente")
# --------------------------------------------------------------------------------
FEATURES = CATEGORY_A + CATEGORY_B + CATEGORY_C + CATEGORY_D
CODED = {"departamento_cat": "departamento", "modalidad_contratacion_cat": "modalidad", "origen_recursos_cat": "origen_recursos", "tipo_contrato_cat": "tipo_contrato", "unspsc_categoria": "segmento"}


def typed_contracts(raw: DataFrame, order: str = "ord") -> DataFrame:
    """One row per contract id, with typed columns under short names."""
    c = lambda n: F.col(f"`{n}`")
    out = raw.select(
        c("ID Contrato").alias("id_contrato"),
        text.text_key(c("Proceso de Compra")).alias("proceso"),
        c("Tipo de Contrato").alias("tipo_contrato"),
        c("Modalidad de Contratacion").alias("modalidad"),
        c("Justificacion Modalidad de Contratacion").alias("justificacion"),
        c("TipoDocProveedor").alias("doc_type"),
        c("Documento Proveedor").alias("doc_number"),
        c("Origen de los Recursos").alias("origen_recursos"),
        money.clean_currency(c("Valor del Contrato")).alias("valor_contrato"),
        F.trim(c("Departamento")).alias("departamento"),
        text.unspsc_segment(c("Codigo de Categoria Principal")).alias("segmento"),
        dates.parse_date(c("Fecha de Firma")).alias("firma"),
        dates.parse_date(c("Fecha de Inicio del Contrato")).alias("inicio"),
        dates.parse_duration(c("Duración del contrato")).alias("duracion_contrato_dias"),
        dedupe.first_missing({f: text.is_blank(c(f)) for f in RuleSet().required_fields}).alias("missing"),
        F.col(order).alias("ord"),
    )
    out = dedupe.keep_first(out, ["id_contrato"], ["ord"])
    number = identity.normalize_number(F.col("doc_number"))
    return out.withColumns({"tipo_norm": identity.normalize_type(F.col("doc_type")), "num_norm": number, "known": F.col("doc_number").isNotNull() & ~identity.is_malformed(number), "dia": dates.day_number(F.col("firma"))})


def typed_processes(raw: DataFrame, order: str = "ord") -> DataFrame:
    """One row per portfolio, the last one."""
    c = lambda n: F.col(f"`{n}`")
    out = raw.select(
        text.text_key(c("ID del Portafolio")).alias("proceso"),
        dates.parse_date(c("Fecha de Publicacion del Proceso")).alias("publicacion"),
        dates.parse_date(c("Fecha de Ultima Publicación")).alias("ultima_publicacion"),
        dates.parse_date(c("Fecha de Recepcion de Respuestas")).alias("recepcion"),
        dates.parse_date(c("Fecha Adjudicacion")).alias("adjudicacion"),
        money.parse_count(c("Proveedores Unicos con Respuestas")).alias("num_proponentes"),
        money.parse_count(c("Respuestas al Procedimiento")).alias("num_ofertas_recibidas"),
        F.col(order).alias("ord"),
    ).filter("proceso is not null")
    return dedupe.keep_last(out, ["proceso"], ["ord"]).drop("ord")


def registrations(raw: DataFrame, order: str = "ord") -> DataFrame:
    """(num_norm, registrado): the first registration of each number, even without a date."""
    out = raw.select(identity.normalize_number(F.col("NIT")).alias("num_norm"), dates.parse_registration_date(F.col("`Fecha Creación`")).alias("registrado"), F.col(order).alias("ord"))
    return dedupe.keep_first(out.filter(~identity.is_malformed(F.col("num_norm"))), ["num_norm"], ["ord"]).drop("ord")


def raw_features(contracts: DataFrame, processes: DataFrame, providers: DataFrame, labels: DataFrame | None = None, bid_rows: DataFrame | None = None) -> DataFrame:
    """Typed contracts with every feature that needs no fitting; rows without a signing date stay, for the caller to filter."""
    keys = ["tipo_norm", "num_norm"]
    out = contracts
    if labels is None:
        out = out.withColumns({"m1": F.lit(0), "m2": F.lit(0)})
    else:
        marks = labels.select("id_contrato", F.col("M1").cast("int").alias("m1"), F.col("M2").cast("int").alias("m2"))
        out = dedupe.lookup(out, marks, ["id_contrato"], {"m1": 0, "m2": 0})
    known = F.col("known") & F.col("dia").isNotNull()
    out = history.attach_history(out, keys, "dia", {"valor_total_contratos_previos_nacional": "valor_contrato", "num_sobrecostos_previos": "m1", "num_retrasos_previos": "m2"}, "num_contratos_previos_nacional", known)
    here = known & F.col("departamento").isNotNull()
    out = history.attach_history(out, [*keys, "departamento"], "dia", {"valor_total_contratos_previos_depto": "valor_contrato"}, "num_contratos_previos_depto", here)
    segments = history.distinct_segments(contracts.filter("known"), keys, "segmento", "n_segments")
    out = dedupe.lookup(out, segments, keys, {"n_segments": 0})
    out = out.withColumn("n_segments", F.when(F.col("known"), F.col("n_segments")).otherwise(0))
    out = out.join(processes.withColumn("has_process", F.lit(True)), "proceso", "left").withColumn("has_process", F.coalesce("has_process", F.lit(False)))
    out = out.join(providers, "num_norm", "left")
    if bid_rows is not None:
        stats = bids.bid_stats(bid_rows.select(F.col("`ID del Proceso de Compra`").alias("proceso"), F.col("`Valor de la Oferta`").alias("valor")), "proceso", "valor")
        out = dedupe.lookup(out, stats, ["proceso"], {"n_bids": 0})
    c = F.col
    start = dates.days_between(c("inicio"), c("firma"))
    rules = RuleSet()
    return out.withColumns(
        {
            "es_contratacion_directa": text.is_direct_award(c("modalidad")),
            "es_regimen_especial": text.is_special_regime(c("modalidad")),
            "es_servicios_profesionales": text.is_professional_services(c("justificacion")),
            "tiene_justificacion_modalidad": text.has_justification(c("justificacion")),
            "dias_firma_a_inicio": start,
            "firma_posterior_a_inicio": (start < 0).cast("int"),
            "mes_firma": F.month("firma"),
            "trimestre_firma": F.quarter("firma"),
            "dias_a_proxima_eleccion": dates.days_to_next(c("firma"), rules.election_days),
            "dias_publicidad": dates.days_clamped(c("recepcion"), c("publicacion")),
            "dias_publicidad_bruto": dates.days_between(c("recepcion"), c("publicacion")),
            "dias_decision": dates.days_clamped(c("firma"), c("ultima_publicacion")),
            "dias_decision_bruto": dates.days_between(c("firma"), c("adjudicacion")),
            "dias_proveedor_registrado": dates.days_clamped(c("firma"), c("registrado")),
            "tipo_persona_proveedor": (c("tipo_norm") == "NIT").cast("int"),
            "proponente_unico": (c("num_proponentes") == 1).cast("int"),
            "num_actividades_economicas": c("n_segments"),
        }
    )


@dataclass(frozen=True)
class Fitted:
    thresholds: DataFrame  # tipo_contrato, variable, percentile, value
    codes: dict[str, DataFrame]  # by feature


def fit(raw: DataFrame, rules: RuleSet = RuleSet()) -> Fitted:
    """Thresholds and codes of raw features; the decision days are calibrated as the flag applies them."""
    measured = raw.select("tipo_contrato", "num_contratos_previos_nacional", F.col("dias_publicidad_bruto").alias("dias_publicidad"), F.col("dias_decision_bruto").alias("dias_decision"), "valor_contrato")
    return Fitted(thresholds.calibrate(measured, "tipo_contrato", min_count=rules.min_group), {f: encoding.category_codes(raw, c, rules.min_share) for f, c in CODED.items()})


def feature_matrix(raw: DataFrame, fitted: Fitted, rules: RuleSet = RuleSet()) -> DataFrame:
    """id_contrato and all features in their fixed order."""
    out = thresholds.attach_thresholds(raw, fitted.thresholds, "tipo_contrato", flags.WANTED, rules.default_thresholds)
    out = flags.rule_scores(flags.rule_flags(out, rules))
    for feature, column in CODED.items():
        out = encoding.encode(out, column, fitted.codes[feature], feature)
    return out.select("id_contrato", *FEATURES)


def drop_reason() -> Column:
    return F.coalesce("missing", F.when(F.col("firma").isNull(), F.lit("fecha_invalida")))

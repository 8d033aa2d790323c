"""The eleven red flags of a contract and the four scores over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RuleSet
from ..functions.text import in_modalities

COMPETITION = ("unico_proponente", "proveedor_multiproposito", "historial_proveedor_alto", "contratacion_directa", "regimen_especial", "periodo_publicidad_extremo")
TRANSPARENCY = ("datos_faltantes", "periodo_decision_extremo")
ANOMALIES = ("proveedor_sobrecostos_previos", "proveedor_retrasos_previos", "ausencia_proceso")
FLAGS = COMPETITION + TRANSPARENCY + ANOMALIES
SCORES = ("iric_score", "iric_competencia", "iric_transparencia", "iric_anomalias")
WANTED = (("num_contratos_previos_nacional", "p95"), ("dias_publicidad", "p99"), ("dias_decision", "p95"), ("valor_contrato", "p99"))


def _above(x: Column, limit: Column) -> Column:
    return F.coalesce(x > limit, F.lit(False)).cast("int")


def rule_flags(df: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    """df with the flags, 0, 1 or null.

    Needs has_process, num_proponentes, n_segments, num_contratos_previos_nacional, modalidad,
    dias_publicidad_bruto and dias_decision_bruto (not clamped), doc_type, doc_number, justificacion,
    valor_contrato, num_sobrecostos_previos, num_retrasos_previos and the thresholds of WANTED.
    """
    c = F.col
    with_process = lambda x: F.when(c("has_process"), x)
    extreme = lambda days, limit: F.when(days.isNotNull(), ((days == 0) | F.coalesce(days > limit, F.lit(False))).cast("int"))
    bad_document = (F.coalesce(c("doc_type"), F.lit("")) == "No Definido") | (F.length(F.coalesce(c("doc_number"), F.lit(""))) < 6)
    reason = F.lower(F.trim(F.coalesce(c("justificacion"), F.lit(""))))
    bad_reason = reason.isin("", "no especificado")
    flags = {
        "unico_proponente": with_process((F.coalesce(c("num_proponentes"), F.lit(0)) <= 1).cast("int")),
        "proveedor_multiproposito": (F.coalesce(c("n_segments"), F.lit(0)) > 1).cast("int"),
        "historial_proveedor_alto": _above(c("num_contratos_previos_nacional"), c("num_contratos_previos_nacional_p95")),
        "contratacion_directa": in_modalities(c("modalidad"), rules.direct_modalities),
        "regimen_especial": in_modalities(c("modalidad"), rules.special_modalities),
        "periodo_publicidad_extremo": with_process(extreme(c("dias_publicidad_bruto"), c("dias_publicidad_p99"))),
        "datos_faltantes": (bad_document | bad_reason | F.coalesce(c("valor_contrato") > c("valor_contrato_p99"), F.lit(False))).cast("int"),
        "periodo_decision_extremo": with_process(extreme(c("dias_decision_bruto"), c("dias_decision_p95"))),
        "proveedor_sobrecostos_previos": (F.coalesce(c("num_sobrecostos_previos"), F.lit(0)) > 0).cast("int"),
        "proveedor_retrasos_previos": (F.coalesce(c("num_retrasos_previos"), F.lit(0)) > 0).cast("int"),
        "ausencia_proceso": (~c("has_process")).cast("int"),
    }
    return df.withColumns(flags)


def rule_scores(df: DataFrame) -> DataFrame:
    """df with the share of raised flags, over all and by dimension; a null flag isn't raised."""
    share = lambda names: sum((F.coalesce(F.col(n), F.lit(0)) for n in names), F.lit(0)) / F.lit(float(len(names)))
    return df.withColumns(dict(zip(SCORES, map(share, (FLAGS, COMPETITION, TRANSPARENCY, ANOMALIES)), strict=True)))

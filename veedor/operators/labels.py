"""The four labels of a contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RuleSet
from ..functions.identity import is_malformed, normalize_number, normalize_type
from ..functions.money import count_or_zero
from .dedupe import keep_first, member_flag, orphans


def amendment_flags(amendments: DataFrame, rules: RuleSet = RuleSet(), id_col: str = "id_contrato", type_col: str = "tipo") -> DataFrame:
    """(id, m1, m2): whether a contract has a value or a time amendment."""
    kind = F.upper(F.trim(F.col(type_col)))
    return amendments.filter(kind.isin(*rules.value_amendments, *rules.time_amendments)).groupBy(F.col(id_col).alias("id_contrato")).agg(F.max(kind.isin(*rules.value_amendments).cast("int")).alias("m1"), F.max(kind.isin(*rules.time_amendments).cast("int")).alias("m2"))


def build_labels(contracts: DataFrame, amendments: DataFrame, bulletins: DataFrame, registry: DataFrame, rules: RuleSet = RuleSet(), order: str = "ord") -> DataFrame:
    """(id_contrato, M1..M4, normalised ids). contracts: portal columns and an ordering column; the first row of an id counts."""
    kept = contracts.select(F.col("`ID Contrato`").alias("id_contrato"), "TipoDocProveedor", "`Documento Proveedor`", "`Dias adicionados`", order)
    kept = keep_first(kept, ["id_contrato"], [order])
    base = kept.select("id_contrato", (count_or_zero(F.col("`Dias adicionados`")) != 0).cast("int").alias("__added"), normalize_type(F.col("TipoDocProveedor")).alias("tipo_documento"), normalize_number(F.col("`Documento Proveedor`")).alias("numero_documento"), F.col("`Documento Proveedor`").isNull().alias("__none"))
    base = base.join(amendment_flags(amendments, rules), "id_contrato", "left")
    zero = F.lit(0)
    base = base.withColumns({"__m1": F.coalesce("m1", zero), "__m2": F.greatest(F.coalesce("m2", zero), F.col("__added"))})
    bad = F.col("__none") | is_malformed(F.col("numero_documento"))
    keys = ["tipo_documento", "numero_documento"]
    listed = bulletins.select(normalize_type(F.col("`tipo de documento`")).alias("tipo_documento"), normalize_number(F.col("`numero de documento`")).alias("numero_documento"))
    listed = listed.filter(~is_malformed(F.col("numero_documento")))
    base = member_flag(base, listed, keys, "__m3", bad)
    base = member_flag(base, registry, keys, "__m4", bad)
    return base.select("id_contrato", *(F.col(f"__m{k}").cast("tinyint").alias(f"M{k}") for k in (1, 2, 3, 4)), F.col("tipo_documento").alias("TipoDocProveedor_norm"), F.col("numero_documento").alias("DocProveedor_norm"))


def unknown_amendments(amendments: DataFrame, contracts: DataFrame) -> DataFrame:
    """Amendments whose contract isn't there."""
    return orphans(amendments, contracts.select(F.col("`ID Contrato`").alias("id_contrato")), ["id_contrato"])


def label_counts(labels: DataFrame, names: tuple[str, ...] = ("M1", "M2", "M3", "M4")) -> DataFrame:
    """(label, positives, zeros, nulls)."""
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("label"), F.col(n).cast("int").alias("value")) for n in names))).alias("p")
    v = F.col("p.value")
    one = F.lit(1)
    return labels.select(pairs).groupBy("p.label").agg(F.count(F.when(v == 1, one)).alias("positives"), F.count(F.when(v == 0, one)).alias("zeros"), F.count(F.when(v.isNull(), one)).alias("nulls"))

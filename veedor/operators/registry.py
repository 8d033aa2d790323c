"""The sanction registry: one identity from several sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import infer_type, is_malformed, normalize_number, normalize_type, reject_reason

SOURCES = ("boletines", "siri", "resp_fiscales", "multas_secop", "colusiones")


def source_rows(df: DataFrame, source: str, number: Column, type_: Column | None = None, name: Column | None = None) -> DataFrame:
    """(source, raw_type, raw_number, tipo_documento, numero_documento) of one source; the type is inferred from name and number where the source has none."""
    raw = df.select(F.lit(source).alias("source"), (type_ if type_ is not None else F.lit(None)).cast("string").alias("raw_type"), number.cast("string").alias("raw_number"), (name if name is not None else F.lit(None)).cast("string").alias("__name"))
    digits = normalize_number(F.col("raw_number"))
    kind = normalize_type(F.col("raw_type")) if type_ is not None else infer_type(F.col("__name"), digits)
    return raw.select("source", "raw_type", "raw_number", kind.alias("tipo_documento"), digits.alias("numero_documento"))


def build_registry(rows: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """One row per identity: a flag for each source and the number of distinct sources."""
    good = rows.filter(~is_malformed(F.col("numero_documento")))
    flags = [F.max(F.col("source") == s).alias(f"en_{s}") for s in sources]
    out = good.groupBy("tipo_documento", "numero_documento").agg(*flags)
    n = reduce(lambda a, b: a + b, (F.col(f"en_{s}").cast("int") for s in sources))
    return out.select("*", F.lit(False).alias("en_sanciones_penales"), n.alias("num_fuentes_distintas"), F.lit(False).alias("malformed"))


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(is_malformed(F.col("numero_documento"))).select("source", "raw_type", "raw_number", reject_reason(F.col("numero_documento")).alias("reason"))


def registry_from_tables(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(registry, rejected rows) from the five sources by their table names."""
    c = F.col
    parts = [
        source_rows(tables["boletines"], "boletines", c("`numero de documento`"), c("`tipo de documento`")),
        source_rows(tables["siri"], "siri", c("numero_documento"), c("tipo_documento")),
        source_rows(tables["resp_fiscales"], "resp_fiscales", c("`Tipo y Num Docuemento`"), name=c("`Responsable Fiscal`")),
        source_rows(tables["multas"], "multas_secop", c("col_5"), name=c("col_6")),
        source_rows(tables["colusiones"], "colusiones", c("Identificacion"), c("`Tipo de Persona Sancionada`")),
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return build_registry(rows), rejected_rows(rows)


def find_identities(registry: DataFrame, probes: DataFrame, type_: str = "tipo", number: str = "numero") -> DataFrame:
    """probes with the registry's columns; malformed numbers find nothing."""
    keyed = probes.withColumns({"tipo_documento": normalize_type(F.col(type_)), "numero_documento": normalize_number(F.col(number))})
    return keyed.join(registry, ["tipo_documento", "numero_documento"], "left")

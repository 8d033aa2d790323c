"""Category codes: frequent values by code point from 1, everything else 0, null stays null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OTHER = "Other"


def category_codes(df: DataFrame, column: str, min_share: float = 0.001) -> DataFrame:
    """(category, code) of the values with more than ``min_share`` of all rows, nulls among these, and Other = 0.

    At most 1/min_share categories qualify, so the result is small whatever the input.
    """
    each = df.groupBy(F.col(column).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    total = each.agg(F.sum("n").alias("total"))
    kept = each.crossJoin(F.broadcast(total)).filter((F.col("n") / F.col("total") > min_share) & F.col("category").isNotNull())  # one row
    codes = kept.select("category", F.row_number().over(Window.orderBy("category")).alias("code"))
    return codes.unionByName(df.sparkSession.createDataFrame([(OTHER, 0)], "category string, code int"))


def encode(df: DataFrame, column: str, codes: DataFrame, to: str) -> DataFrame:
    """df with the code of a column: unseen values 0, null null."""
    known = codes.filter("code > 0").select(F.col("category").alias("__category"), F.col("code").alias("__code"))
    out = df.join(F.broadcast(known), F.col(column).cast("string") == F.col("__category"), "left")
    return out.withColumn(to, F.when(F.col(column).isNotNull(), F.coalesce("__code", F.lit(0)))).drop("__category", "__code")


def code_lookup(column: Column, mapping: dict[str, int]) -> Column:
    """The same for a mapping that is at hand, without a join."""
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))]
    found = F.try_element_at(F.create_map(*pairs), column.cast("string")) if pairs else F.lit(None)
    return F.when(column.isNotNull(), F.coalesce(found, F.lit(0)))


def decode(df: DataFrame, column: str, codes: DataFrame, to: str) -> DataFrame:
    return df.join(F.broadcast(codes.select(F.col("code").alias(column), F.col("category").alias(to))), column, "left")


def indicator_sums(df: DataFrame, key: str, column: str, values: list[str]) -> DataFrame:
    """Per key, how often each of some values occurs: one column a value."""
    return df.groupBy(key).agg(*(F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values))

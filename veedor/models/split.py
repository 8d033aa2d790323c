"""Deterministic splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stratified_split(df: DataFrame, label: str, share: float = 0.7, order: Sequence[Column] | None = None, id_col: str = "id", seed: int = 42) -> DataFrame:
    """df with ``train``: in each class, the first ``share`` of its rows in a (hashed) order.

    Ranks are taken in two levels, within hash buckets and then by bucket totals, so that a class of
    any size is ranked in many tasks. An explicit order takes one window per class.
    """
    if order is not None:
        w = Window.partitionBy(label)
        n = F.count(F.lit(1)).over(w)
        return df.withColumn("train", F.row_number().over(w.orderBy(*order)) <= F.round(share * n))
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    rows = df.withColumns({"__h": h, "__b": F.shiftrightunsigned(h, 54)})
    totals = rows.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(label)
    totals = totals.select(label, "__b", F.coalesce(F.sum("__n").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(w).alias("__all"))
    ranked = rows.withColumn("__r", F.row_number().over(Window.partitionBy(label, "__b").orderBy("__h", id_col)))
    out = ranked.join(totals, [label, "__b"])
    return out.withColumn("train", F.col("__r") + F.col("__before") <= F.round(share * F.col("__all"))).select(*df.columns, "train")


def folds(df: DataFrame, label: str, k: int, id_col: str = "id", seed: int = 42) -> DataFrame:
    """df with ``fold`` 0..k-1, even within classes up to chance of the hash."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(id_col), F.col(label), F.lit(seed + 1)), F.lit(k)).cast("int"))


def upsample(df: DataFrame, label: str, share: float = 0.25, id_col: str = "id", seed: int = 42) -> DataFrame:
    """The minority class with replacement until it is ``share`` of all rows: exactly int(n_major * share / (1 - share)) draws.

    Draw k takes the row whose number, in the order of the hashed split, is a hash of k: rows are
    numbered in two levels, and the draws are an equi-join.
    """
    n = {int(r[0]): r[1] for r in df.groupBy(label).count().collect()}
    small, large = (1, 0) if n.get(1, 0) <= n.get(0, 0) else (0, 1)
    if not n.get(small):
        return df
    want = int(n[large] * share / (1 - share))
    rows = df.filter(F.col(label) == small).withColumns({"__h": F.xxhash64(id_col, F.lit(seed))}).withColumn("__b", F.shiftrightunsigned("__h", 54))
    totals = rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    totals = totals.select("__b", F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # 1,024 rows
    numbered = rows.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy("__h", id_col))).join(F.broadcast(totals), "__b")
    numbered = numbered.withColumn("__k", F.col("__before") + F.col("__r") - 1)
    draws = df.sparkSession.range(want).select(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n[small])).alias("__k")).groupBy("__k").agg(F.count(F.lit(1)).alias("__times"))
    drawn = numbered.join(draws, "__k").withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).select(*df.columns)
    return df.filter(F.col(label) == large).unionByName(drawn)

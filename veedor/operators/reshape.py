"""Long to wide, roll-ups and period counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flatten_events(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str | Column], width: int) -> DataFrame:
    """One row per key with columns c_1..c_width: the first ``width`` events in order."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    ranked = df.withColumn("__n", rn).filter(F.col("__n") <= width)
    return ranked.groupBy(key).agg(*(F.max(F.when(F.col("__n") == i, F.col(c))).alias(f"{c}_{i}") for i in range(1, width + 1) for c in columns))


def pivot_counts(df: DataFrame, key: str | Column, column: str, values: Sequence[str]) -> DataFrame:
    """Rows of each key by value; the values are given, so no pass looks for them."""
    out = df.groupBy(key).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return out.fillna(0, subset=list(values))


def period_counts(df: DataFrame, day: str, period: str = "month") -> DataFrame:
    return df.groupBy(F.date_trunc(period, F.col(day)).cast("date").alias("period")).agg(F.count(F.lit(1)).alias("n"))


def portfolio_rollup(df: DataFrame, key: str, total: str, day: str, price: str) -> DataFrame:
    """(key, total, first_day, last_day, mean_price)."""
    return df.groupBy(key).agg(F.sum(total).alias("total"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.avg(price).alias("mean_price"))


def entity_profile(df: DataFrame, key: str, value: str, kinds: Sequence[str], kind: str, distinct: Sequence[str], first: str, order: str) -> DataFrame:
    """Sum, counts of each kind, sizes of value sets and the first value of each entity, in one aggregation."""
    return df.groupBy(key).agg(F.sum(value).alias("total"), *(F.count(F.when(F.col(kind) == k, 1)).alias(f"n_{k}") for k in kinds), *(F.countDistinct(c).alias(f"distinct_{c}") for c in distinct), F.min_by(first, order).alias(f"first_{first}"))


def top_entities(df: DataFrame, key: str, value: str, n: int = 5) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias("mean")).orderBy(F.desc("mean"), key).limit(n)

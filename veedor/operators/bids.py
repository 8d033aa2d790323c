"""Statistics of the bids of a process."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_kurtosis(n: Column, s1: Column, s2: Column, s3: Column, s4: Column) -> Column:
    """Unbiased excess kurtosis from the number of values and the sums of their powers (of distances from any fixed point); null under four values and for equal ones."""
    m = s1 / n
    second = s2 / n - m * m
    fourth = s4 / n - 4 * m * s3 / n + 6 * m * m * s2 / n - 3 * m * m * m * m
    excess = F.try_divide(fourth, second * second) - 3
    return F.when((n >= 4) & (second > 0), (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * excess + 6))


def bid_stats(bids: DataFrame, key: str, value: str) -> DataFrame:
    """(key, curtosis_licitacion, diferencia_relativa_norm, n_bids) over bids above zero with a key.

    One scan and two shuffles: equal bids are counted, then a window over the distinct bids of a key
    gives each its distance from the lowest and the lowest its successor, and one aggregation on the
    same partitioning does the rest. Powers of distances from the lowest bid lose nothing to a large
    common amount.
    """
    x = F.col(value).cast("double")
    good = bids.select(key, x.alias("__x")).filter(F.col("__x").isNotNull() & ~F.isnan("__x") & (F.col("__x") > 0) & F.col(key).isNotNull())
    each = good.groupBy(key, "__x").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(key).orderBy("__x")
    each = each.select(key, "__x", F.col("__n").cast("double").alias("__n"), F.first("__x").over(w).alias("__low"), F.lead("__x").over(w).alias("__next"))
    d = F.col("__x") - F.col("__low")
    lowest = F.col("__x") == F.col("__low")
    power = lambda k: F.sum(F.col("__n") * F.pow(d, F.lit(float(k)))).alias(f"__s{k}")
    second = F.max(F.when(lowest, F.when(F.col("__n") > 1, F.col("__x")).otherwise(F.col("__next")))).alias("__second")
    sums = each.groupBy(key).agg(F.sum("__n").alias("n"), F.min("__x").alias("__a"), second, *(power(k) for k in (1, 2, 3, 4)))
    n, c = F.col("n"), F.col
    drn = F.when(n >= 3, (c("__second") - c("__a")) / c("__a"))
    return sums.select(key, sample_kurtosis(n, c("__s1"), c("__s2"), c("__s3"), c("__s4")).alias("curtosis_licitacion"), drn.alias("diferencia_relativa_norm"), n.cast("long").alias("n_bids"))

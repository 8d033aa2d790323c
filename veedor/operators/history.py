"""Strict as-of history: counts and sums over what a provider had before a day, the day excluded.

Rows are summed per key and day first, and the window runs over days: exact, because its frame is in
days, and a provider with very many contracts costs one row a day in its window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_history(rows: DataFrame, keys: Sequence[str], day: str, sums: dict[str, str], count: str = "n_prior") -> DataFrame:
    """(keys, day, count, sums) strictly before each day that rows have. sums: output name to column; null values count as 0."""
    daily = rows.groupBy(*keys, day).agg(F.count(F.lit(1)).alias(count), *(F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items()))
    before = Window.partitionBy(*keys).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
    return daily.select(*keys, day, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in (count, *sums)))


def attach_history(rows: DataFrame, keys: Sequence[str], day: str, sums: dict[str, str], count: str = "n_prior", valid: Column | None = None) -> DataFrame:
    """rows with their history; zeros where ``valid`` fails (unknown provider, no department)."""
    known = rows if valid is None else rows.filter(valid)
    past = asof_history(known.filter(F.col(day).isNotNull()), keys, day, sums, count)
    out = rows.join(past, [*keys, day], "left")
    for c in (count, *sums):
        value = F.coalesce(F.col(c), F.lit(0))
        out = out.withColumn(c, value if valid is None else F.when(F.coalesce(valid, F.lit(False)), value).otherwise(F.lit(0)))
    return out


def probe_history(probes: DataFrame, rows: DataFrame, keys: Sequence[str], day: str, sums: dict[str, str], count: str = "n_prior") -> DataFrame:
    """probes (keys and day, any days) with the history of rows strictly before them.

    Rows and probes go through one window over the union of their days instead of a range join.
    """
    names = (count, *sums)
    daily = rows.filter(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.count(F.lit(1)).alias(count), *(F.sum(c).alias(n) for n, c in sums.items()))
    days = daily.unionByName(probes.select(*keys, day).distinct(), allowMissingColumns=True).groupBy(*keys, day).agg(*(F.sum(n).alias(n) for n in names))
    before = Window.partitionBy(*keys).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
    past = days.select(*keys, day, *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in names))
    out = probes.join(past, [*keys, day], "left")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in names})


def distinct_segments(rows: DataFrame, keys: Sequence[str], segment: str, name: str = "n_segments") -> DataFrame:
    """Distinct segments of each key over all time."""
    return rows.filter(F.col(segment).isNotNull()).groupBy(*keys).agg(F.countDistinct(segment).alias(name))

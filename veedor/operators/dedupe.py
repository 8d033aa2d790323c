"""One row per key, with a total order that names the winner (nulls first going up, last going down); flags, lookups and orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _winner(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The planner keeps one row a key in every task before it shuffles, so a hot key is no large group."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", first).filter("__rank = 1").drop("__rank")


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _winner(df, keys, [c.asc() for c in _cols(order)])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _winner(df, keys, [c.desc() for c in _cols(order)])


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """A left join that keeps left's rows; columns of right take their default where nothing fits. right: one row per key."""
    out = left.join(right, list(keys), "left")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def member_flag(left: DataFrame, members: DataFrame, keys: Sequence[str], name: str, unknown: Column | None = None) -> DataFrame:
    """left with 1 for rows whose keys are among members, else 0; null where ``unknown`` holds."""
    hit = members.select(*keys).distinct().withColumn("__hit", F.lit(1))
    flag = F.coalesce(F.col("__hit"), F.lit(0))
    out = left.join(hit, list(keys), "left")
    return out.withColumn(name, flag if unknown is None else F.when(~F.coalesce(unknown, F.lit(True)), flag)).drop("__hit")


def orphans(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def without_orphans(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), list(keys), "left_semi")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, or a ValueError if a key repeats (a validated merge)."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"key is not unique: {twice[0].asDict()}")
    return df


def first_missing(fields: dict[str, Column]) -> Column:
    """The name of the first field whose condition (it is missing) holds, else null."""
    out = F.lit(None).cast("string")
    for name in reversed(list(fields)):
        out = F.when(fields[name], name).otherwise(out)
    return out


def drop_counts(df: DataFrame, reason: Column) -> DataFrame:
    return df.select(reason.alias("reason")).filter("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def resume(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What of todo has not been done."""
    return orphans(todo, done, keys)

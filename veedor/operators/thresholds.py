"""Percentile thresholds per group, with a rest group and built-in defaults behind them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_THRESHOLDS

VARIABLES = ("num_contratos_previos_nacional", "dias_publicidad", "dias_decision", "valor_contrato")
PERCENTILES = {"p1": 0.01, "p5": 0.05, "p95": 0.95, "p99": 0.99}
REST = "Otro"
STRETCHES = 32  # of the value range, ranked apart


def merge_rare(df: DataFrame, group: str, min_count: int = 30, rest: str = REST) -> DataFrame:
    """Groups with fewer rows, and null, become the rest group. Counts are pre-aggregated and joined back."""
    n = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).filter((F.col("__n") >= min_count) & F.col(group).isNotNull())
    out = df.join(n.withColumn("__kept", F.col(group)), group, "left")
    return out.withColumn(group, F.coalesce("__kept", F.lit(rest))).drop("__n", "__kept")


def exact_percentiles(df: DataFrame, group: str | None, variables: Sequence[str], points: Sequence[float]) -> DataFrame:
    """(g, variable, values): for each group and variable the percentiles, linearly interpolated over the values that are there.

    Equal values are counted first. Ranks are prefix sums in two levels, within stretches of the value
    range that approximate percentiles cut out and then over the stretches, so no task holds or sorts
    all values of a dominant group. Groups without a value have no row; a null group is a group.
    """
    clean = lambda v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double"))
    each = F.explode(F.array(*(F.struct(F.lit(v).alias("variable"), clean(v).alias("x")) for v in variables)))
    rows = df.select((F.col(group) if group else F.lit(0)).alias("g"), each.alias("r")).select("g", "r.variable", "r.x").filter("x is not null")
    counts = rows.groupBy("g", "variable", "x").agg(F.count(F.lit(1)).alias("n"))
    cuts = F.percentile_approx("x", [i / STRETCHES for i in range(1, STRETCHES)], 10 * STRETCHES)
    edges = counts.groupBy(F.col("g").alias("h"), F.col("variable").alias("v")).agg(cuts.alias("edges"), F.sum("n").alias("total"))
    same = F.col("g").eqNullSafe(F.col("h")) & (F.col("variable") == F.col("v"))
    placed = counts.join(edges, same).withColumn("part", F.size(F.filter("edges", lambda e: e < F.col("x")))).select("g", "variable", "x", "n", "total", "part")
    totals = placed.groupBy(F.col("g").alias("h"), F.col("variable").alias("v"), F.col("part").alias("p")).agg(F.sum("n").alias("m"))
    earlier = Window.partitionBy("h", "v").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("h", "v", "p", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("ahead"))
    ranked = placed.join(totals, same & (F.col("part") == F.col("p")))
    upto = F.col("ahead") + F.sum("n").over(Window.partitionBy("g", "variable", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.select("g", "variable", "x", "n", "total", upto.alias("upto"))
    at = lambda rank: F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("x")))
    picked = []
    for q in points:
        place = F.lit(float(q)) * (F.col("total") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        picked.append(low + (high - low) * (F.max(place) - F.floor(F.max(place))))
    return ranked.groupBy("g", "variable").agg(F.array(*picked).alias("values"))


def calibrate(df: DataFrame, group: str, variables: Sequence[str] = VARIABLES, percentiles: Mapping[str, float] = PERCENTILES, min_count: int = 30) -> DataFrame:
    """(group, variable, percentile, value): linear interpolation over the values that are there; groups without any have no row."""
    merged = merge_rare(df.select(group, *variables), group, min_count)
    wide = exact_percentiles(merged, group, variables, tuple(percentiles.values()))
    rows = F.explode(F.array(*(F.struct(F.lit(p).alias("percentile"), F.get("values", F.lit(i)).alias("value")) for i, p in enumerate(percentiles))))
    return wide.select(F.col("g").alias(group), "variable", rows.alias("r")).select(group, "variable", "r.percentile", "r.value")


def wide_thresholds(long: DataFrame, group: str, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per group, a column ``variable_percentile`` for each that is wanted."""
    return long.groupBy(group).agg(*(F.max(F.when((F.col("variable") == v) & (F.col("percentile") == p), F.col("value"))).alias(f"{v}_{p}") for v, p in wanted))


def attach_thresholds(df: DataFrame, long: DataFrame, group: str, wanted: Sequence[tuple[str, str]], defaults: Mapping[tuple[str, str], float] = DEFAULT_THRESHOLDS, rest: str = REST) -> DataFrame:
    """df with ``variable_percentile``: the row's group, else the rest group, else the default, else null."""
    wide = wide_thresholds(long, group, wanted)
    names = [f"{v}_{p}" for v, p in wanted]
    fallback = wide.filter(F.col(group) == rest).agg(*(F.max(n).alias(f"__{n}") for n in names))  # one row
    out = df.join(wide, group, "left").crossJoin(F.broadcast(fallback))
    for (v, p), n in zip(wanted, names, strict=True):
        out = out.withColumn(n, F.coalesce(F.col(n), F.col(f"__{n}"), F.lit(defaults.get((v, p))).cast("double")))
    return out.drop(*(f"__{n}" for n in names))


def to_nested(long: DataFrame, group: str) -> dict[str, dict[str, dict[str, float]]]:
    """group to variable to percentile to value, of a table as small as the groups are few."""
    out: dict[str, dict[str, dict[str, float]]] = {}
    for g, v, p, x in long.select(group, "variable", "percentile", "value").toLocalIterator():
        out.setdefault(g, {}).setdefault(v, {})[p] = x
    return out


def with_group_median(df: DataFrame, group: str, value: str, to: str) -> DataFrame:
    """df with the median of the row's group, null where it has no values."""
    middle = exact_percentiles(df, group, (value,), (0.5,)).select(F.col("g").alias("__g"), F.get("values", F.lit(0)).alias(to))
    return df.join(middle, F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g")


def fill_group_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Null values become the median of their group."""
    out = with_group_median(df, group, value, "__m")
    return out.withColumn(value, F.coalesce(F.col(value), F.col("__m"))).select(*df.columns)


def quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """(column, q, value)."""
    wide = exact_percentiles(df, None, columns, points)
    rows = F.explode(F.array(*(F.struct(F.lit(q).alias("q"), F.get("values", F.lit(i)).alias("value")) for i, q in enumerate(points))))
    return wide.select(F.col("variable").alias("column"), rows.alias("r")).select("column", "r.q", "r.value")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) of every pair of columns, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*(F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("r")) for i, (a, b) in enumerate(pairs))))
    return wide.select(rows.alias("x")).select("x.*")


"""Ranking, curve, threshold and calibration metrics as aggregates.

Positions of all rows by score would need one ordered pass in one task. Rows are first summed per
distinct score and then over the scores in two levels; only metrics of the top k rank rows, and these
are at most k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRETCHES = 64  # of the score range, summed apart
THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))


def top_ranked(df: DataFrame, score: str, label: str, id_col: str, k: int) -> DataFrame:
    """(rank, y) of the k best rows, ties by id."""
    best = df.select(F.col(score).alias("s"), F.col(label).cast("double").alias("y"), F.col(id_col).alias("i")).orderBy(F.desc("s"), "i").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("s"), "i"))).select("rank", "y")


def mean_average_precision(df: DataFrame, score: str, label: str, id_col: str, ks: Sequence[int] = (100, 500, 1000)) -> DataFrame:
    """(k, map): the mean of precision at each hit among the first k, 0 without a hit."""
    top = top_ranked(df, score, label, id_col, max(ks))
    top = top.withColumn("p", F.sum("y").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)) / F.col("rank"))
    wide = top.agg(*(F.coalesce(F.avg(F.when((F.col("y") == 1) & (F.col("rank") <= k), F.col("p"))), F.lit(0.0)).alias(str(k)) for k in ks))
    return _long(wide, ks, "map")


def _long(wide: DataFrame, ks: Sequence[int], name: str) -> DataFrame:
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"`{k}`").alias(name)) for k in ks)))
    return wide.select(rows.alias("r")).select("r.*")


def recall_precision(df: DataFrame, score: str, label: str, id_col: str, ks: Sequence[int] = (10, 50, 100, 500, 1000)) -> DataFrame:
    """(k, recall, precision); k is clamped to the number of rows."""
    top = top_ranked(df, score, label, id_col, max(ks))
    hits = top.agg(*(F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col("y"))), F.lit(0.0)).alias(str(k)) for k in ks))
    all_ = df.agg(F.sum(F.col(label).cast("double")).alias("pos"), F.count(F.lit(1)).alias("n"))
    long = _long(hits, ks, "hits").crossJoin(F.broadcast(all_))  # one row
    zero = F.lit(0.0)
    return long.select("k", F.coalesce(F.try_divide("hits", "pos"), zero).alias("recall"), F.coalesce(F.try_divide(F.col("hits"), F.least("k", "n")), zero).alias("precision"))


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    y = F.col(label).cast("double")
    return df.groupBy(F.col(score).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("p"))


def _running(by: DataFrame, sums: dict[str, str], best_first: bool) -> DataFrame:
    """by (a row per distinct score s) with running sums over the scores, output name to column.

    In two levels: within stretches of the score range that approximate percentiles cut out, and over
    the totals of these, so that any number of distinct scores is summed in many tasks.
    """
    cuts = by.agg(F.percentile_approx("s", [i / STRETCHES for i in range(1, STRETCHES)], 10 * STRETCHES).alias("edges"))
    part = F.size(F.filter("edges", lambda e: e < F.col("s"))) * (-1 if best_first else 1)
    placed = by.crossJoin(F.broadcast(cuts)).withColumn("part", part).drop("edges")  # one row
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over STRETCHES rows
    totals = placed.groupBy("part").agg(*(F.sum(c).alias(f"__{n}") for n, c in sums.items()))
    totals = totals.select("part", *(F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in sums))
    here = Window.partitionBy("part").orderBy(F.desc("s") if best_first else F.asc("s")).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(F.broadcast(totals), "part")
    return out.select(*by.columns, *((F.sum(c).over(here) + F.col(f"__{n}")).alias(n) for n, c in sums.items()))


def _upto(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, best first: n, p and their sums so far (tn, tp)."""
    return _running(_by_score(df, score, label), {"tn": "n", "tp": "p"}, True)


def ndcg(df: DataFrame, score: str, label: str, id_col: str, ks: Sequence[int] = (100, 500, 1000)) -> DataFrame:
    """(k, ndcg) with binary gains; tied scores share the mean of their discounts.

    The discounts of a tie are summed over its positions inside the first k only, so at most k terms.
    """
    ties = _upto(df, score, label).withColumn("first", F.col("tn") - F.col("n") + 1).filter(F.col("first") <= max(ks))
    at = ties.select("n", "p", F.explode(F.sequence("first", F.least(F.col("tn"), F.lit(max(ks))))).alias("rank"))
    gain = F.col("p") / F.col("n") / F.log2(F.col("rank") + 1.0)
    got = at.agg(*(F.coalesce(F.sum(F.when(F.col("rank") <= k, gain)), F.lit(0.0)).alias(str(k)) for k in ks))
    pos = df.agg(F.sum(F.col(label).cast("double")).alias("pos"))
    ideal = pos.select(F.explode(F.when(F.col("pos") >= 1, F.sequence(F.lit(1), F.least(F.col("pos").cast("int"), F.lit(max(ks)))))).alias("rank"))
    best = ideal.agg(*(F.sum(F.when(F.col("rank") <= k, 1.0 / F.log2(F.col("rank") + 1.0))).alias(str(k)) for k in ks))
    both = _long(got, ks, "got").join(_long(best, ks, "best"), "k")
    return both.select("k", F.coalesce(F.try_divide("got", "best"), F.lit(0.0)).alias("ndcg"))


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """(auc) by rank sums, ties averaged; null unless both classes occur."""
    ranks = _running(_by_score(df, score, label), {"upto": "n"}, False).withColumn("rank", F.col("upto") - (F.col("n") - 1) / 2.0)
    pos, neg = F.sum("p"), F.sum(F.col("n") - F.col("p"))
    return ranks.agg(F.try_divide(F.sum(F.col("rank") * F.col("p")) - pos * (pos + 1) / 2.0, pos * neg).alias("auc"))


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, fpr, tpr), a row per distinct score."""
    pts = _upto(df, score, label)
    all_ = pts.agg(F.sum("p").alias("pos"), F.sum(F.col("n") - F.col("p")).alias("neg"))
    return pts.crossJoin(F.broadcast(all_)).select(F.col("s").alias("threshold"), F.try_divide(F.col("tn") - F.col("tp"), F.col("neg")).alias("fpr"), F.try_divide("tp", "pos").alias("tpr"))


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, precision, recall), a row per distinct score."""
    pts = _upto(df, score, label)
    all_ = pts.agg(F.sum("p").alias("pos"))
    return pts.crossJoin(F.broadcast(all_)).select(F.col("s").alias("threshold"), (F.col("tp") / F.col("tn")).alias("precision"), F.try_divide("tp", "pos").alias("recall"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """(ap): the sum of recall steps times precision."""
    return _upto(df, score, label).agg(F.try_divide(F.sum(F.col("p") * F.col("tp") / F.col("tn")), F.sum("p")).alias("ap"))


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """(threshold, tn, fp, fn, tp, precision, recall, f1) in one pass: rows are counted by the thresholds they reach."""
    s, y = F.col(score), F.col(label).cast("long")
    steps = sorted(thresholds)
    reached = sum((F.when(s >= t, 1).otherwise(0) for t in steps), F.lit(0))
    cells = df.groupBy(reached.alias("r")).agg(F.sum(y).alias("p"), F.count(F.lit(1)).alias("n"))
    total = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    rows = []
    for i, t in enumerate(steps):
        up, down = F.col("r") > i, F.col("r") <= i
        rows.append(F.struct(F.lit(float(t)).alias("threshold"), (total("n", down) - total("p", down)).alias("tn"), (total("n", up) - total("p", up)).alias("fp"), total("p", down).alias("fn"), total("p", up).alias("tp")))
    long = cells.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("x")).select("x.*")
    zero = F.lit(0.0)
    long = long.withColumns({"precision": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), zero), "recall": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), zero)})
    return long.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of the best f1, the lowest threshold of equals."""
    return sweep.orderBy(F.desc(F.round("f1", 12)), "threshold").limit(1)


def calibration(df: DataFrame, score: str, label: str) -> DataFrame:
    """(brier, baseline, skill)."""
    y, s = F.col(label).cast("double"), F.col(score).cast("double")
    out = df.agg(F.avg((s - y) * (s - y)).alias("brier"), (F.avg(y) * (1 - F.avg(y))).alias("baseline"))
    return out.withColumn("skill", F.when(F.col("baseline") > 0, 1 - F.col("brier") / F.col("baseline")).otherwise(0.0))


def score_histogram(df: DataFrame, score: str, label: str, bins: int = 50) -> DataFrame:
    """(bin, label, n) of scores in [0, 1]."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    return df.groupBy(at.cast("int").alias("bin"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def reliability(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """(bin, n, mean_score, share) of a calibration plot."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("share"))


def metric_delta(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("model", "metric"), value: str = "value") -> DataFrame:
    """keys, v1, v2, delta (6 places) of what either side has."""
    both = old.select(*keys, F.col(value).alias("v1")).join(new.select(*keys, F.col(value).alias("v2")), list(keys), "full")
    return both.withColumn("delta", F.round(F.col("v2") - F.col("v1"), 6))


def top_attributions(df: DataFrame, id_col: str, feature: str, value: str, n: int = 10) -> DataFrame:
    """The n strongest attributions of each row: id, feature, value, rank."""
    w = Window.partitionBy(id_col).orderBy(F.desc(F.abs(F.col(value))), feature)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def global_attributions(df: DataFrame, feature: str, value: str, n: int = 10) -> DataFrame:
    """(feature, mean_abs) of the n features with the largest mean."""
    return df.groupBy(feature).agg(F.round(F.avg(F.abs(F.col(value))), 6).alias("mean_abs")).orderBy(F.desc("mean_abs"), feature).limit(n)

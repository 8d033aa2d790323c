"""Graph operators of the requirements: as-of edges, name matching, hops, concentration, ego networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_name
from .shared import checkpointed
from .thresholds import with_group_median

FEW = 8.0  # names that a key of grams is expected to fit
KEY = 4  # grams of a key at most
_SLACK = 1e-9  # of sums of doubles


def nodes_of(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(kind, id) of all node tables, given with their key column."""
    parts = [df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id")).filter("id is not null").distinct() for kind, (df, key) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def edges_asof(edges: DataFrame, day: Column, at: Column) -> DataFrame:
    """Edges known by a day; those without a date stay."""
    return edges.filter(day.isNull() | (day <= at))


def ngram_match(left: DataFrame, right: DataFrame, left_id: str, left_name: str, right_id: str, right_name: str, n: int = 3, min_similarity: float = 0.85, top: int = 3) -> DataFrame:
    """(left_id, right_id, similarity): TF-IDF cosine over character n-grams of normalised names.

    Equal names collapse first. What a match does not share is at most 1 - min_similarity² of a
    vector's square, so the rarest grams that both have are found by skipping no more than that:
    names meet at keys made of them (see ``_keys``). Only the names that meet are compared.
    """
    both = [df.select(F.lit(side).alias("side"), normalize_name(F.col(name)).alias("name")).filter("name <> ''") for side, df, name in (("l", left, left_name), ("r", right, right_name))]
    names = both[0].unionByName(both[1]).distinct()
    counts = checkpointed(_grams(names, n).groupBy("gram").agg(F.count(F.lit(1)).alias("df")))
    total = checkpointed(names.agg(F.count(F.lit(1)).alias("total")))
    if n <= 3:  # of letters, digits and blanks: 37³ at most
        counts = F.broadcast(counts)

    keys = _keys(_vectors(names, counts, total, n), 1 - min_similarity * min_similarity, n)
    a, b = (keys.filter(F.col("side") == side).select("key", F.col("name").alias(at), F.col("xs").alias(f"x{at}"), F.col("rest").alias(f"r{at}")) for side, at in (("l", "a"), ("r", "b")))
    most = F.aggregate(F.zip_with("xa", "xb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) + F.sqrt(F.col("ra") * F.col("rb"))
    pairs = checkpointed(a.join(b, "key").filter(most >= min_similarity - _SLACK).select("a", "b").distinct())
    met = pairs.select(F.lit("l").alias("side"), F.col("a").alias("name")).unionByName(pairs.select(F.lit("r").alias("side"), F.col("b").alias("name"))).distinct()
    vectors = _vectors(met, counts, total, n)
    va, vb = (vectors.filter(F.col("side") == side).select(F.col("name").alias(at), F.col("v").alias(f"v{at}")) for side, at in (("l", "a"), ("r", "b")))
    weights = F.map_from_entries(F.transform("vb", lambda e: F.struct(e["gram"], e["x"])))
    dot = F.aggregate("va", F.lit(0.0), lambda s, e: s + e["x"] * F.coalesce(F.try_element_at("wb", e["gram"]), F.lit(0.0)))
    like = pairs.join(va, "a").join(vb.select("b", weights.alias("wb")), "b").select("a", "b", dot.alias("similarity")).filter(F.col("similarity") >= min_similarity)
    best = Window.partitionBy("a").orderBy(F.desc("similarity"), "b")
    like = like.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    l = left.select(F.col(left_id).alias("left_id"), normalize_name(F.col(left_name)).alias("a"))  # noqa: E741
    r = right.select(F.col(right_id).alias("right_id"), normalize_name(F.col(right_name)).alias("b"))
    return l.join(like, "a").join(r, "b").select("left_id", "right_id", F.round("similarity", 6).alias("similarity"))


def _grams(names: DataFrame, n: int) -> DataFrame:
    """(side, name, gram, tf)"""
    padded = F.concat(F.lit(" "), F.col("name"), F.lit(" "))
    g = F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))), lambda i: F.substr(padded, i, F.lit(n)))
    return names.select("side", "name", F.explode(g).alias("gram")).groupBy("side", "name", "gram").agg(F.count(F.lit(1)).alias("tf"))


def _vectors(names: DataFrame, counts: DataFrame, total: DataFrame, n: int) -> DataFrame:
    """(side, name, total, v): v has gram, df and x, its weight in the unit vector, by ascending frequency."""
    w = F.col("tf") * (F.log((1.0 + F.col("total")) / (1.0 + F.col("df"))) + 1.0)
    each = _grams(names, n).join(counts, "gram").crossJoin(F.broadcast(total)).select("side", "name", "total", "gram", "df", w.alias("w"))
    v = each.groupBy("side", "name").agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("df", "gram", "w"))).alias("v"))
    v = v.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e["w"] * e["w"])))
    return v.select("side", "name", "total", F.transform("v", lambda e: F.struct(e["gram"].alias("gram"), e["df"].alias("df"), (e["w"] / F.col("norm")).alias("x"))).alias("v"))


def _keys(vectors: DataFrame, budget: float, n: int) -> DataFrame:
    """(side, name, key, xs, rest): all that the rarest grams shared with a match can be; the weights of these grams, and the square of those behind them.

    A key goes on until few names are expected to fit it, or to the end of the shared grams. Whether it
    goes on depends on its own grams alone, so both names of a match have the key of what they share.
    A gram that continues another one of the key by a letter is expected in a tenth of the names that fit.
    """
    upto = F.aggregate("v", F.array(F.lit(0.0)), lambda s, e: F.concat(s, F.array(F.element_at(s, -1) + e["x"] * e["x"])))
    none = F.array().cast("array<string>"), F.array().cast("array<double>")
    start = F.struct(F.lit(0).alias("next"), F.lit(0.0).alias("skipped"), none[0].alias("key"), none[1].alias("xs"), F.col("total").cast("double").alias("fit"), F.lit(False).alias("done"))
    rows = vectors.select("side", "name", "total", "v", upto.alias("upto"), F.size("v").alias("size"), start.alias("s"))
    skipped = lambda q: F.col("s.skipped") + F.get("upto", q) - F.get("upto", F.col("s.next"))
    ended = F.struct(F.col("size").alias("next"), skipped(F.col("size")).alias("skipped"), F.concat("s.key", F.array(F.lit(""))).alias("key"), F.concat("s.xs", F.array(F.lit(0.0))).alias("xs"), F.col("s.fit").alias("fit"), F.lit(True).alias("done"))
    for k in range(1, KEY + 1):

        def longer(q: Column, k: int = k) -> Column:
            gram, df, x = (F.get("v", q)[f] for f in ("gram", "df", "x"))
            follows = F.exists(F.col("s.key"), lambda p: (F.substr(p, F.lit(2)) == F.substr(gram, F.lit(1), F.lit(n - 1))) | (F.substr(gram, F.lit(2)) == F.substr(p, F.lit(1), F.lit(n - 1))))
            fit = F.col("s.fit") * F.when(follows, F.lit(0.1)).otherwise(df / F.col("total"))
            return F.struct((q + 1).alias("next"), skipped(q).alias("skipped"), F.concat("s.key", F.array(gram)).alias("key"), F.concat("s.xs", F.array(x)).alias("xs"), fit.alias("fit"), ((fit <= FEW) | F.lit(k == KEY)).alias("done"))

        there = F.when(F.col("s.next") < F.col("size"), F.sequence("s.next", F.col("size") - 1)).otherwise(F.array().cast("array<int>"))
        more = F.transform(F.filter(there, lambda q: skipped(q) <= budget + _SLACK), longer)
        last = F.filter(F.array(ended), lambda e: e["skipped"] <= budget + _SLACK)
        rows = rows.withColumn("s", F.explode(F.when(F.col("s.done"), F.array("s")).otherwise(F.concat(more, last))))
    rest = F.greatest(F.get("upto", F.col("size")) - F.get("upto", F.col("s.next")), F.lit(0.0))
    return rows.select("side", "name", F.col("s.key").alias("key"), F.col("s.xs").alias("xs"), rest.alias("rest"))


def two_hops(first: DataFrame, second: DataFrame) -> DataFrame:
    """(source, via, target) over two tables of (source, target)."""
    return first.select("source", F.col("target").alias("via")).join(second.select(F.col("source").alias("via"), "target"), "via").select("source", "via", "target").distinct()


def concentration(df: DataFrame, owner: str, member: str, value: str) -> DataFrame:
    """(owner, hhi, n_members): the sum of squared shares of members in an owner's total."""
    each = df.groupBy(owner, member).agg(F.sum(value).alias("v"))
    all_ = each.groupBy(owner).agg(F.sum("v").alias("t"), F.count(F.lit(1)).alias("n_members"), F.sum(F.col("v") * F.col("v")).alias("q"))
    return all_.select(owner, F.try_divide(F.col("q"), F.col("t") * F.col("t")).alias("hhi"), "n_members")


def ratio_to_median(df: DataFrame, group: str, value: str) -> DataFrame:
    return with_group_median(df, group, value, "__m").withColumn("ratio", F.try_divide(F.col(value), F.col("__m"))).drop("__m")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of (source, target) edges, by minimum labels with pointer jumping, until nothing changes."""
    both = edges.select("source", "target").unionByName(edges.select(F.col("target").alias("source"), F.col("source").alias("target"))).filter("source is not null and target is not null").distinct()
    both = checkpointed(both)
    now = checkpointed(both.select(F.col("source").alias("node")).distinct().withColumn("component", F.col("node")))
    while True:
        near = both.join(now.select(F.col("node").alias("target"), F.col("component").alias("c")), "target").groupBy(F.col("source").alias("node")).agg(F.min("c").alias("c"))
        step = now.join(near, "node").select("node", F.least("component", "c").alias("component"))
        jump = checkpointed(step.join(step.select(F.col("node").alias("component"), F.col("component").alias("up")), "component", "left").select("node", F.least("component", "up").alias("component")))
        settled = jump.join(now.withColumnRenamed("component", "old"), "node").filter("component <> old").isEmpty()
        now = jump
        if settled:
            return now


def community_features(members: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(component, size, total) of (node, component) with values by node."""
    return members.join(values.select("node", value), "node", "left").groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum(value).alias("total"))


def ego_network(edges: DataFrame, center: str, hops: int = 2, cap: int = 50, score: str | None = None) -> DataFrame:
    """(node, hop) within some hops of a node; each hop keeps its ``cap`` best by score, then id."""
    spark = edges.sparkSession
    weight = F.col(score) if score else F.lit(0.0)
    both = edges.select("source", "target", weight.alias("w")).unionByName(edges.select(F.col("target").alias("source"), F.col("source").alias("target"), weight.alias("w")))
    seen = spark.createDataFrame([(center, 0)], "node string, hop int")
    front = seen.select("node")
    for h in range(1, hops + 1):
        reach = both.join(F.broadcast(front), both["source"] == front["node"], "left_semi").groupBy(F.col("target").alias("node")).agg(F.max("w").alias("w"))
        front = reach.join(seen, "node", "left_anti").orderBy(F.desc("w"), "node").limit(cap).select("node")
        seen = seen.unionByName(front.withColumn("hop", F.lit(h)))
    return seen

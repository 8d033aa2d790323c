"""Percentiles, running sums, bids, samples and components against plain computations, and the plans that they take."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from veedor import queries
from veedor.models.split import upsample
from veedor.operators import bids, dedupe, graph, ranking, thresholds


def test_percentiles_are_exact(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([float(rng.randint(0, 9)), rng.gauss(0, 50), None, float("nan")])) for _ in range(700)]
    rows += [("one", 4.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    points = (0.0, 0.01, 0.5, 0.95, 1.0)
    for stretches in (32, 2):
        monkeypatch.setattr(thresholds, "STRETCHES", stretches)
        got = {r["g"]: r["values"] for r in thresholds.exact_percentiles(df, "g", ["v"], points).collect()}
        want = {}
        for g, v in rows:
            if v is not None and v == v:
                want.setdefault(g, []).append(v)
        assert set(got) == set(want)
        for g, v in want.items():
            assert got[g] == pytest.approx([np.percentile(v, 100 * p) for p in points])
    assert thresholds.exact_percentiles(df.limit(0), "g", ["v"], points).count() == 0


def test_running_sums_in_stretches(spark):
    rng = random.Random(2)
    rows = [(rng.random(), rng.randint(0, 1)) for _ in range(500)] + [(0.5, 1)] * 40
    df = spark.createDataFrame(rows, "s double, y int")
    got = {r["s"]: (r["tn"], r["tp"]) for r in ranking._upto(df, "s", "y").collect()}
    for s in {s for s, _ in rows}:
        assert got[s] == (sum(t >= s for t, _ in rows), sum(y for t, y in rows if t >= s))


def test_bids_far_from_zero(spark):
    rng = random.Random(3)
    data = {k: [1e9 + rng.randint(0, 30) for _ in range(n)] for k, n in zip("abcdef", (1, 2, 3, 4, 9, 40), strict=True)} | {"same": [7.0] * 6}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("a", -1.0), ("a", None), (None, 3.0)], "k string, v double")
    got = {r["k"]: r for r in bids.bid_stats(df, "k", "v").collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        n, x = len(vs), np.array(sorted(vs)) - min(vs)
        assert got[k]["n_bids"] == n
        assert got[k]["diferencia_relativa_norm"] == (pytest.approx((sorted(vs)[1] - min(vs)) / min(vs)) if n >= 3 else None)
        m2, m4 = ((x - x.mean()) ** 2).mean(), ((x - x.mean()) ** 4).mean()
        want = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2**2 - 3) + 6) if n >= 4 and m2 else None
        assert got[k]["curtosis_licitacion"] == (None if want is None else pytest.approx(want))


def test_upsampling_draws_an_exact_number(spark):
    df = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(1000)], "id long, y int")
    got = upsample(df, "y", 0.25).groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in got} == {0: 950, 1: int(950 * 0.25 / 0.75)}
    again = [sorted(r["id"] for r in upsample(df, "y", 0.25).filter("y = 1").collect()) for _ in range(2)]
    assert again[0] == again[1] and len(set(again[0])) > 45


def test_components_are_those_of_brute_force(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(45)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(100)] + [(None, "n00")]
    group = {n: n for e in edges if None not in e for n in e}
    for a, b in edges:
        if a is not None:
            low, high = sorted((group[a], group[b]))
            group = {n: low if g == high else g for n, g in group.items()}
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "source string, target string")).collect()}
    assert got == group


def test_winners_keep_a_row_a_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), F.lit(None).cast("string").alias("x"))
    out = dedupe.keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, out.collect())) == [(0, 0, None), (1, 1, None), (2, 2, None)]
    assert sorted(r["o"] for r in dedupe.keep_last(df, ["k"], ["o"]).collect()) == [97, 98, 99]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_rule_scores_read_the_deduplicated_table(spark):
    out = queries.rule_scores(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [l_" not in plan and "Scan ExistingRDD" in plan and out.count() > 4000


def test_small_helpers(spark, tmp_path):
    from veedor.config import load_score_config
    from veedor.sources import reader
    from veedor.streaming import scoring

    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    got = reader.header_inventory(spark, [str(tmp_path / "a.csv")]).collect()
    assert [(r["position"], r["column"]) for r in got] == [(0, "x"), (1, "y")]
    pages = [spark.createDataFrame([(1, "a")], "i int, s string"), spark.createDataFrame([("b", 2)], "s string, i int"), spark.createDataFrame([(3,)], "i int")]
    assert sorted(map(tuple, reader.union_pages(pages).collect()), key=str) == [(1, "a"), (2, "b"), (3, None)]
    (tmp_path / "score.json").write_text('{"iric": 0.4, "m1_cost_overruns": 0.6, "risk_thresholds": {"high": [0.5, 1.0], "very_low": [0.0, 0.5]}}')
    rules = load_score_config(str(tmp_path / "score.json"))
    assert rules.score_weights == {"iric": 0.4, "m1_cost_overruns": 0.6} and [b[0] for b in rules.risk_bands] == ["Very Low", "High"]
    spark.createDataFrame([("2024-01-01 05:00:00", "d", 2.0), ("2024-01-01 09:00:00", "d", 3.0)], "t string, modalidad string, valor_contrato double").selectExpr("cast(t as timestamp) t", "modalidad", "valor_contrato").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, modalidad string, valor_contrato double").parquet(str(tmp_path / "in"))
    query = scoring.award_counts(stream, "t").writeStream.format("memory").queryName("awards").outputMode("complete").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [(r["n"], r["valor"]) for r in spark.table("awards").collect()] == [(2, 5.0)]


def test_names_are_compared_only_with_likely_matches(spark, monkeypatch):
    """Numbered names share most of their grams: all matches are those of all pairs, and few others are compared."""
    import math
    from collections import Counter

    rng = random.Random(6)
    left = [f"Proveedor {rng.randrange(3000):09d}" for _ in range(150)] + ["Obras del Norte SAS", "A", ""]
    right = [f"PROVEEDOR - {i:09d}" for i in range(0, 3000, 5)] + ["Obras del Norte S.A.S.", "obras del nortes sas", "a", None]
    clean = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").upper()).split())
    names = {(s, clean(t)) for s, ts in (("l", left), ("r", right)) for t in ts if clean(t)}
    grams = {k: Counter(p[i : i + 3] for p in [f" {k[1]} "] for i in range(len(p) - 2)) for k in names}
    df = Counter(g for c in grams.values() for g in c)
    unit = {}
    for k, c in grams.items():
        w = {g: tf * (math.log((1 + len(names)) / (1 + df[g])) + 1) for g, tf in c.items()}
        unit[k] = {g: x / math.sqrt(sum(y * y for y in w.values())) for g, x in w.items()}
    seen = []
    monkeypatch.setattr(graph, "checkpointed", lambda t, real=graph.checkpointed: seen.append(real(t)) or seen[-1])
    tables = [spark.createDataFrame([*enumerate(ts)], "id int, name string") for ts in (left, right)]
    for least in (0.85, 0.7):
        like = {(a, b): s for _, a in (k for k in names if k[0] == "l") for _, b in (k for k in names if k[0] == "r") if (s := sum(x * unit["r", b].get(g, 0) for g, x in unit["l", a].items())) >= least}
        want = sorted((i, j) for i, t in enumerate(left) for j, u in enumerate(right) if (clean(t), clean(u)) in like)
        seen.clear()
        got = sorted((r["left_id"], r["right_id"]) for r in graph.ngram_match(*tables, "id", "name", "id", "name", min_similarity=least, top=1000).collect())
        assert got == want and len(want) > 20
        compared = [t.count() for t in seen if t.columns == ["a", "b"]]
        assert len(compared) == 1 and compared[0] <= len(left) * len(right) // 20

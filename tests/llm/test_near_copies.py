"""The near_dedup stage against all pairs of five-word sets."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from veedor.llm import near_copies


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


def grams(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def expected(rows):
    sets, group = [grams(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                group = [group[j] if g == group[i] else g for g in group]
    best = {}
    for (i, _), g in zip(rows, group, strict=True):
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    return sorted((i for none, i in best.values() if not none)), len(best)


def planted():
    """Copies with a few words changed, on both sides of similarity 0.8, chains of them, one large group and a common passage."""
    rng, out = random.Random(5), []
    passage = words(rng, 60)
    for base in range(40):
        text = words(rng, rng.randint(30, 260))
        if base % 4 == 0:
            text = passage + text[:40]
        out.append(text)
        for _ in range(4):
            copy = list(rng.choice([text, out[-1]]))
            for _ in range(rng.randint(1, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(99))
            out.append(copy)
    large = words(rng, 80)
    for i in range(60):
        out.append([*large[: 40 + i % 40], *words(rng, 3)])
    texts = [" ".join(t) for t in out] + [None, "", " \n", "One two", "one TWO", "one two three four five", "one two three four five six"]
    rng.shuffle(texts)
    return [(None if i % 29 == 7 else i, t) for i, t in enumerate(texts)]


def test_near_copies_go(spark):
    """No document goes that all pairs would keep, and at most one in twenty stays that should go."""
    rows = planted()
    ids, n = expected(rows)
    assert n < len(rows) - 100
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit(1), "key": F.lit("k"), "c": F.lit(2)})
    got = corpus_pipeline.near_dedup(spark, df.repartition(3), "")
    assert got.columns == df.columns
    got = got.collect()
    assert {r["doc_id"] for r in got if r["doc_id"] is not None} >= set(ids) and n <= len(got) <= n + (len(rows) - n) // 20
    assert any(r["text"] in (None, "", " \n") for r in got)


def test_all_links_with_enough_blocks(spark):
    rows = planted()
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), recall=0.9999).collect()
    assert (sorted(r["doc_id"] for r in got if r["doc_id"] is not None), len(got)) == expected(rows)


def test_pairs_that_balls_must_meet_at(spark):
    """All pairs of blocks within two bits and no others, components apart, from crowded variants too; bits that are far apart count as no pair."""
    rng, width = random.Random(3), 16
    plan = near_copies.Plan(width, 2, 80)
    rows = []
    for k in range(12):
        center = [rng.getrandbits(width) for _ in range(2)]
        for i in range(8):
            rows.append((10 * k + i, [2**62 - 1 if i == 7 else 0] * near_copies.CHECK + [c ^ sum(1 << b for b in rng.sample(range(width), rng.randint(0, 2))) for c in center], 10 * k + i % 3))
    comp = spark.createDataFrame([(n, c) for n, _, c in rows], "node long, component long")
    nodes = near_copies._named(spark.createDataFrame([r[:2] for r in rows], "node long, bits array<long>"), comp)
    pairs, of = near_copies._meetings(near_copies._classes(nodes, plan), plan, 0, 2, 3)
    got = near_copies._stars(pairs, of, nodes, plan).collect()
    component = {n: c for n, _, c in rows}
    assert all(component[r["a"]] != component[r["b"]] for r in got)
    between = near_copies._between(of, nodes, comp, plan).collect()
    assert len(between) == len({tuple(r) for r in between})
    got = [*{tuple(r) for r in [*got, *between]}]
    want = {(a, b) for a, x, c in rows for b, y, d in rows if a < b and c != d and x[0] == y[0] and any((p ^ q).bit_count() <= 2 for p, q in zip(x[near_copies.CHECK :], y[near_copies.CHECK :], strict=True))}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_pairs_below_the_similarity_are_told_by_parities(spark):
    """A family of texts at all similarities to each other: no similar pair is lost, and hardly another becomes a row."""
    rng = random.Random(8)
    base, rows = words(rng, 120), [(0, None), (1, "")]
    for i in range(2, 90):
        text = list(base)
        for k in rng.sample(range(120), i % 6):
            text[k] = words(rng, 1)[0]
        rows.append((i, " ".join(text)))
    plan = near_copies.Plan(16, 11, 80)
    sigs = near_copies._signatures(spark.createDataFrame(rows, f"{near_copies.RID} long, text string").withColumn("doc_id", F.col(near_copies.RID)), "doc_id", plan)
    nodes = sigs.filter("n > 0").select(F.col(near_copies.RID).alias("node"), "bits")
    pairs = nodes.select(F.col("node").alias("a")).join(nodes.select(F.col("node").alias("b")), F.col("a") < F.col("b"))
    got = {(r["a"], r["b"]) for r in near_copies._close(pairs, nodes, plan).collect()}
    sets = {i: grams(t) for i, t in rows if t}
    want = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.1 * len(want)
    for a, b in want:
        x, y = (near_copies.bin_parities(near_copies.shingle_set(dict(rows)[k].encode())) for k in (a, b))
        assert 9 * (x ^ y).sum() <= len(sets[a]) + len(sets[b])
    assert not near_copies.bin_parities(near_copies.shingle_set(None)).any()


def test_layout_keeps_its_promise():
    rng = np.random.default_rng(4)
    for n in (100, 50_000, 10**9):
        width, blocks = near_copies.layout(n, 0.8)
        met = 0
        for _ in range(200):
            common = rng.integers(-(2**62), 2**62, 800)
            sides = [np.concatenate((common, rng.integers(-(2**62), 2**62, 100))) for _ in range(2)]
            a, b = (near_copies.fingerprint_bits(s, width * blocks).reshape(blocks, width) for s in sides)
            met += ((a ^ b).sum(1) <= 2).any()
        assert met >= 180


def test_row_numbers_do_not_follow_the_cores(spark, tmp_path):
    rows = planted()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(7).write.parquet(f"file://{tmp_path}/d")
    docs = spark.read.parquet(f"file://{tmp_path}/d")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
    try:
        out = near_copies.drop_near_copies(docs)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "8")
        assert {r["doc_id"] for r in out.collect()} >= set(expected(rows)[0])
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_no_documents(spark):
    assert near_copies.drop_near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0

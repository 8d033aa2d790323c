"""The corpus operators against brute force, and on nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veedor.llm import decontaminate, knn_quality, mixing, preferences, repeated_bytes, repetition, simhash, token_counts, token_files, urls
from veedor.llm.components import connected_components
from veedor.llm.encoding import Encoder, vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, size long, fp long, id long, begin long, sid long, epoch long, spans long, shard long, bucket long"
WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu") for b in ("", "l", "m", "n", "ra", "se", "to")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    base = [prose(rng, rng.randint(20, 120)) for _ in range(30)]
    texts = [*base, base[0], base[0], base[1] + " x", base[2][:300] + base[3], None, "", "  \n\t", "one", "a " * 400, "é" * 250, "é" * 250 + "x", prose(rng, 9000), "Ünï <|endoftext|> 'S don't 12,5 \x1f y", "line one here\nline one here\nother\n\n"]
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 11 == 3 else f"s{i % 4}", None) for i, t in enumerate(texts)]
    return [*rows, (None, base[4], None, None, None), (None, None, None, None, None), (3, base[5], "en", "s1", 1), (3, base[5], "en", "s1", 1)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame([(*r, *range(1, 11)) for r in corpus], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- quality rules ---


def counts(text):
    w = (text or "").encode().split()
    n, longest = len(w), []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
        longest.append(best)
    rep = {p for i, x in enumerate(longest) if x >= 5 for p in range(i, i + 5)}
    cov = {p for i, x in enumerate(longest) if x >= 2 for p in range(i, i + x)}
    return n, len(rep), len(cov), max(longest, default=0)


def maximal(words, least):
    """All substrings that occur twice or more and can be extended on neither side, with their number of occurrences."""
    n, found = len(words), {}
    for size in range(least, n):
        places = {}
        for i in range(n - size + 1):
            places.setdefault(tuple(words[i : i + size]), []).append(i)
        for w, at in places.items():
            if len(at) > 1 and len({words[i - 1] if i else None for i in at}) > 1 and len({words[i + size] if i + size < n else None for i in at}) > 1:
                found[w] = len(at)
            elif len(at) > 1 and (at[0] == 0 or at[-1] + size == n):
                left = {words[i - 1] if i else ("edge", i) for i in at}
                right = {words[i + size] if i + size < n else ("edge", i) for i in at}
                if len(left) > 1 and len(right) > 1:
                    found[w] = len(at)
    return found


def test_intervals_are_all_maximal_repeats():
    rng = random.Random(6)
    for _ in range(150):
        w = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(2, 40))]
        x, doc, end = np.array(w), np.zeros(len(w), np.int64), np.full(len(w), len(w))
        order, common = repetition.suffix_array(x, doc, end)
        assert [tuple(w[i:]) for i in order] == sorted(tuple(w[i:]) for i in range(len(w)))
        least = rng.randint(1, 3)
        first, last, size, inner = repetition.maximal_repeats(order, common, np.array([-1, *w[:-1]]), least)
        got = {tuple(w[order[a] : order[a] + n]): b - a + 1 for a, b, n in zip(first.tolist(), last.tolist(), size.tolist(), strict=True)}
        assert len(got) == len(first) and got == maximal(w, least)
        spans = {p for i, n in zip(order[inner > 0].tolist(), inner[inner > 0].tolist(), strict=True) for p in range(i, i + n)}
        assert spans == {p for m in got for i in range(len(w) - len(m) + 1) if tuple(w[i : i + len(m)]) == m for p in range(i, i + len(m))}


def test_the_limits_reject_by_themselves(spark):
    rng = random.Random(8)
    phrases = [prose(rng, 2) for _ in range(12)]
    phrasy = " ".join(p + " " + prose(rng, 3) for p in phrases + phrases[::-1])
    passage = prose(rng, 60)
    long_ = " ".join([passage, prose(rng, 400), passage, prose(rng, 300)])
    d = spark.createDataFrame([(1, phrasy), (2, long_), (3, prose(rng, 300))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in repetition.quality_rules(d).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [got[i]["kept"] for i in (1, 2, 3)] == [False, False, True]


def test_repetition(spark, corpus, docs, empty):
    short = [r for r in corpus if len(r[1] or "") < 3000]
    got = Counter((r["doc_id"], r["n_words"], r["n_repeat_words"], r["covered_words"], r["longest_repeat"]) for r in repetition.quality_rules(docs).filter("n_words < 2000").collect())
    assert got == Counter((r[0], *counts(r[1])) for r in short)
    rng = random.Random(2)
    for _ in range(60):
        t = " ".join(rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 50)))
        f = repetition.analyse([t.encode()], repetition.RepetitionRules())
        assert tuple(int(f[k][0]) for k in ("n_words", "n_repeat_words", "covered_words", "longest_repeat")) == counts(t)
    by = {r["doc_id"]: r for r in repetition.quality_rules(docs).collect()}
    last = len(corpus) - 5
    assert (by[last]["n_dup_lines"], by[last]["n_symbols"], by[last]["word_chars"]) == (1, 0, 27)
    assert repetition.quality_rules(empty).count() == 0
    kept = repetition.drop_low_quality(docs)
    assert kept.columns == docs.columns and kept.count() == repetition.quality_rules(docs).filter("kept").count()


# --- SimHash ---


def plain_fingerprint(text):
    import xxhash

    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in (text or "").encode().split()]
    if not w:
        return 0
    parts = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(corpus, docs, empty):
    got = simhash.near_duplicates(docs).collect()
    fps = [plain_fingerprint(r[1]) for r in corpus]
    assert Counter((r["doc_id"], r["fp"] % 2**64) for r in got) == Counter((r[0], f) for r, f in zip(corpus, fps, strict=True))
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                group = [group[j] if g == group[i] else g for g in group]
    name = {g: min((r[0] for r, h in zip(corpus, group, strict=True) if h == g and r[0] is not None), default=None) for g in group}
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((r[0], name[g]) for r, g in zip(corpus, group, strict=True))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert simhash.near_duplicates(empty).count() == simhash.drop_near_duplicates(empty).count() == 0


def test_ball_links_find_all(spark):
    rng = random.Random(4)
    a = [rng.getrandbits(64) for _ in range(20)]
    fps = {x for v in a for x in (v, v ^ 1 << rng.randrange(64), v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))} | {a[0] ^ 1 << i for i in range(64)}
    signed = [x - 2**64 if x >> 63 else x for x in fps]
    links = simhash.ball_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    comp = {r["node"]: r["component"] for r in connected_components(links).collect()}
    for x in signed:
        for y in signed:
            if x != y and ((x ^ y) % 2**64).bit_count() <= 2:
                assert comp[x] == comp[y]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}


# --- decontamination ---


def test_leaks(spark, docs, empty):
    rng = random.Random(11)
    items = [prose(rng, 40), prose(rng, 25), "too short", None, ""]
    edited = items[0].split()
    edited[5], edited[17] = "zzz", "yyy"
    del edited[30]
    held = [(1, "x y z " + items[1] + " end"), (2, "Start, " + " ".join(edited).upper() + "!"), (3, prose(rng, 50)), (4, None), (5, ""), (None, items[1]), (6, " ".join(items[0].split()[:8]) + prose(rng, 60))]
    d = spark.createDataFrame(held, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(d, bench).collect()}
    assert set(got) == {(1, 1), (2, 0), (None, 1)}
    assert (got[1, 1]["similarity"], got[1, 1]["doc_begin"], got[1, 1]["doc_end"]) == (1.0, 3, 28)
    assert got[2, 0]["similarity"] == pytest.approx((2 * 37 - 2 - 1) / 80)
    blocks = decontaminate.leaks(d, bench, decontaminate.LeakRules(block_bytes=1))
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == set(got)
    assert Counter(r["doc_id"] for r in decontaminate.drop_leaks(d, bench).collect()) == Counter([3, 4, 5, 6])
    assert decontaminate.leaks(empty, bench).count() == decontaminate.leaks(d, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs, bench).count() == docs.count()


def test_a_passage_in_most_documents_is_still_found(spark):
    rng = random.Random(12)
    item = prose(rng, 30)
    d = spark.createDataFrame([(i, prose(rng, 20) + " " + item if i % 3 else prose(rng, 50)) for i in range(60)], "doc_id long, text string")
    got = decontaminate.leaks(d, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.count() == 40


def test_alignment_equals_plain_smith_waterman():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = rng.integers(0, 4, 9), rng.integers(0, 4, 14)
        h = np.zeros((10, 15), int)
        for i in range(9):
            for j in range(14):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        window = np.concatenate((np.full(9, -1), b, np.full(9, -1)))  # a band wide enough for all of it
        score, end, _ = decontaminate.align(a[None], np.array([9]), window[None])
        assert score[0] == h.max() and h[:, end[0] - 9].max() == h.max()


def smith_waterman(a, b):
    """The best score of aligning all of two word lists."""
    row, best = np.zeros(len(b) + 1, int), 0
    b = np.array(b)
    for w in a:
        new = np.maximum(np.maximum(row[:-1] + np.where(b == w, 2, -1), row[1:] - 1), 0)
        new = np.maximum.accumulate(new + np.arange(len(b))) - np.arange(len(b))
        row = np.concatenate(([0], new))
        best = max(best, int(row.max()))
    return best


def test_seeds_find_what_aligning_all_pairs_finds(spark):
    """Copies with up to a fourth of their words changed, dropped or put in, against the alignment of every text with every item."""
    rng = random.Random(17)
    items = [prose(rng, rng.randint(8, 60)) for _ in range(30)] + ["two words", prose(rng, 1)]
    texts = []
    for i in range(120):
        words = items[i % 30].split()
        for _ in range(int(len(words) * rng.random() / 4)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [rng.choice(["new" + str(rng.randrange(99)), words[at]])] * rng.randint(0, 1)
        texts.append(prose(rng, rng.randint(0, 50)) + " " + " ".join(words) + " " + prose(rng, rng.randint(0, 50)))
    texts += [prose(rng, 80) for _ in range(30)] + ["here are two words in it", "two other words"]
    tokens = [[w.decode() for w in decontaminate.words_of(t)] for t in texts]
    want = {(d, i) for i, t in enumerate(items[:30]) for d, x in enumerate(tokens) if smith_waterman(y := [w.decode() for w in decontaminate.words_of(t)], x) >= len(y)}
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast("decimal(20,0)"))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string").withColumn("item_id", F.col("item_id").cast("smallint"))
    got = {(int(r["doc_id"]), r["item_id"]) for r in decontaminate.leaks(d, bench, decontaminate.LeakRules(rare_share=0.01)).collect()}
    long_ = {g for g in got if g[1] < 30}
    assert long_ <= want and len(long_) >= 0.95 * len(want) and len(want) >= 100
    assert (150, 30) in got and (151, 30) not in got


def test_hot_grams_and_long_items_are_bounded():
    import tracemalloc

    rng = random.Random(18)
    items = [f"which of these {i}w is {i}x the {i}y" for i in range(20_000)]
    block = decontaminate.Block(list(range(20_000)), items, 3)
    texts = [" ".join(["which of these", prose(rng, 5)] * 10) for _ in range(20)]
    tracemalloc.start()
    assert decontaminate.block_leaks(block, np.zeros(len(block.grams), bool), texts, decontaminate.LeakRules()) == []
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    words = [f"w{rng.randrange(3000)}" for _ in range(100_000)]
    block = decontaminate.Block([1], [" ".join(words)], 3)
    edited = [w for i, w in enumerate(words) if i % 1000]
    tracemalloc.reset_peak()
    got = decontaminate.block_leaks(block, np.zeros(len(block.grams), bool), ["x y " + " ".join(edited[:70_000])], decontaminate.LeakRules())
    tracemalloc.stop()
    assert len(got) == 1 and got[0][2] > 130_000


def test_repeated_rows_and_items(spark):
    rng = random.Random(19)
    item = prose(rng, 20)
    d = spark.createDataFrame([(1, item), (1, item), (2, f"{item} . {item}")], "doc_id long, text string")
    got = decontaminate.leaks(d, spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")).collect()
    assert Counter(r["doc_id"] for r in got) == {1: 4, 2: 2} and all((r["doc_begin"], r["doc_end"], r["similarity"]) == (0, 20, 1.0) for r in got)


# --- mixing ---


def test_mix(corpus, docs, empty):
    m = mixing.mix(docs, block=16)
    got = mixing.taken(m).collect()
    sizes = Counter()
    for r in corpus:
        sizes[r[3]] += len((r[1] or "").encode().split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight, cap = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {s: 2.0 * sizes[s] for s in names}
    target, open_, left = {}, list(names), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > cap[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = cap[s]
            left -= cap[s]
            open_.remove(s)
    by = {r["source"]: r for r in m.sources.collect()}
    assert {s: pytest.approx(t) for s, t in target.items()} == {s: by[s]["target"] for s in names}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got) and len(got) == len(corpus)
    assert sum(r["taken"] for r in got) == sum(int(t + 0.5) for t in target.values())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.taken(mixing.mix(docs, block=16)).collect()), key=str)
    slots = sorted(m.schedule.collect())
    assert len({s[0] for s in slots}) == len(slots)
    for sid in {s[1] for s in slots}:
        assert [s[2] for s in slots if s[1] == sid] == list(range(sum(s[1] == sid for s in slots)))
    out = mixing.mixed_documents(docs, block=16)
    assert out.columns == docs.columns
    assert {r["slot"] for r in m.pieces.collect()} == {s[0] for s in slots}
    check_mixed(m, docs, [r.asDict() for r in out.withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect()])
    assert mixing.taken(mixing.mix(empty)).count() == mixing.mixed_documents(empty).count() == 0


def check_mixed(m, docs, rows):
    """Whole documents at their first slots, and every source near its share in every prefix of the mix."""
    where = {(r["epoch"], r["a"], r["sid"]): r for r in sorted(m.pieces.collect(), key=lambda r: -r["slot"])}
    size = {(r["sid"], r["begin"]): r["size"] for r in m.documents.collect() if r["size"]}
    source = {r["sid"]: r for r in m.sources.collect()}
    want = []
    for (epoch, a, sid), r in where.items():
        n = size[sid, a - epoch * source[sid]["source_size"]]
        if 2 * min(n, source[sid]["words"] - a) >= n:
            want.append((r["slot"], a, source[sid]["source"], n))
    assert [(r["source"], len(r["text"].encode().split())) for r in rows] == [(s, n) for _, _, s, n in sorted(want, key=lambda w: w[:2])]
    slots = sorted((r["slot"], r["sid"]) for r in m.schedule.collect())
    seen, space = Counter(), 1 << len(slots).bit_length()
    for i, (slot, sid) in enumerate(slots):
        seen[sid] += 1
        assert abs(seen[sid] - (slot + 1) * source[sid]["slots"] / space) < 1.5 + np.log2(space)


def test_the_schedule_decides(spark, corpus, docs, monkeypatch):
    plain = mixing._schedule
    before = {r["doc_id"]: r for r in mixing.taken(mixing.mix(docs, block=16)).collect()}
    monkeypatch.setattr(mixing, "_schedule", lambda *a: plain(*a).withColumn("slot", F.lit(7).cast("long")))
    after = {r["doc_id"]: r for r in mixing.taken(mixing.mix(docs, block=16)).collect()}
    assert all(r["first_slot"] == 7 for r in after.values() if r["taken"]) and before != after


def test_rows_that_repeat_are_spread(spark, monkeypatch):
    rows = [(None, "same words here", "s")] * 500 + [(i, f"w{i} x", "s") for i in range(100)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = sorted(map(tuple, mixing.taken(mixing.mix(d, block=4)).collect()), key=str)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 40)
    monkeypatch.setattr(mixing, "HOT_KEYS", 100)
    base = d.select(F.monotonically_increasing_id().alias(mixing.RID), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("key"))
    sizes = mixing._buckets(base, 600).groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("z")).orderBy("bucket").collect()
    assert max(r["n"] for r in sizes) < 100 and all(x["z"] <= y["a"] for x, y in zip(sizes, sizes[1:], strict=False))
    assert sorted(map(tuple, mixing.taken(mixing.mix(d, block=4)).collect()), key=str) == before


def test_the_mix_keeps_columns_with_clashing_names(spark):
    names = ["__n", "__size", "__epoch", "part", "slot", "a", "doc"]
    d = spark.createDataFrame([(i, f"some words {i} " * 9, f"s{i % 3}") for i in range(30)], "doc_id long, text string, source string").withColumns({n: F.lit(1) for n in names})
    out = mixing.mixed_documents(d, block=4)
    assert out.columns == d.columns and 30 <= out.count() <= 60


# --- repeated bytes ---


@pytest.mark.parametrize("length", [20, 21, 200])
def test_repeated_bytes(corpus, docs, empty, length):
    texts = [(r[0], (r[1] or "").encode()) for r in corpus]
    seen = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    want = Counter()
    for i, b in texts:
        m = np.zeros(len(b) + 2, int)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                m[p + 1 : p + 1 + length] = 1
        kept = bytes(np.frombuffer(b, np.uint8)[m[1:-1] == 0])
        want[i, len(b), len(b) - len(kept), int((np.diff(m) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    how = {20: {"anchor": 8, "bin_bytes": 3000}, 21: {"anchor": 8, "bin_bytes": 30}, 200: {}}[length]  # 30: every anchor is a hot one
    out = repeated_bytes.remove_repeats(docs, length, **how)
    rows = out.collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == want
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and sum(s["stop"] - s["begin"] for s in r["spans"]) == r["n_removed"] for r in rows)
    assert repeated_bytes.remove_repeats(empty).count() == 0


def test_a_hot_anchor_is_spread(spark):
    """A passage in many documents, other text around it in each: only the passage goes, whichever way its anchors take."""
    rng = random.Random(13)
    passage = prose(rng, 40)
    d = spark.createDataFrame([(i, prose(rng, 40) + passage + prose(rng, 40)) for i in range(150)], "doc_id long, text string")
    one, other = (sorted(map(tuple, repeated_bytes.remove_repeats(d, 200, bin_bytes=size, with_text=False).collect())) for size in (repeated_bytes.BIN_BYTES, 2000))
    assert one == other and all(len(passage) <= r[2] <= len(passage) + 40 and r[3] == 1 for r in one)


def test_construction_equals_sorting():
    rng = np.random.default_rng(1)
    length, anchor = 6, 3
    members, before, starts = [], [], []
    for _ in range(60):
        n = int(rng.integers(1, 4))
        starts.append(n)
        before.append(int(rng.integers(n - 1, 4)))
        members.append(bytes(rng.integers(0, 2, length + n - 1).astype(np.uint8)))
    before, starts = np.array(before), np.array(starts)
    got = repeated_bytes.repeating_starts(members, before, starts, length, anchor)
    for t in range(length - anchor + 1):
        here = {k: members[k][t - (3 - before[k]) :][:length] for k in range(60) if 0 <= t - (3 - before[k]) < starts[k]}
        n = Counter(here.values())
        assert {k for k in range(60) if got[t, k]} == {k for k, w in here.items() if n[w] > 1}


# --- tokens ---


def plain_ids(text, specials=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = specials
    return t.encode(text or "", add_special_tokens=False).ids


def test_encoder(corpus):
    e = Encoder(vocabulary_path())
    texts = [r[1] for r in corpus] + ["İstanbul ŒUVRE ÿŸ ª x<|startoftext|>y", "a×b c÷d É À", "x" * 500]
    for _ in range(2):
        for t, got in zip(texts, e.encode([None if t is None else t.encode() for t in texts]), strict=True):
            assert np.frombuffer(got, e.dtype).tolist() == plain_ids(t)
    whole = Encoder(vocabulary_path("byte_bpe_50k.json"))
    assert not whole.by_units and len(whole.encode([b"hello there"])[0]) == 4


def test_long_texts_are_encoded_in_parts(monkeypatch):
    from veedor.llm import encoding

    monkeypatch.setattr(encoding, "CHUNK", 64)
    e, text = Encoder(vocabulary_path()), prose(random.Random(1), 200)
    assert np.frombuffer(e.encode([text.encode(), b"x" * 300], 1)[0], e.dtype).tolist() == [*plain_ids(text), 1]


def test_store_round_trip(spark, corpus, docs, empty):
    store = token_files.write_store(docs, shard_bytes=4000)
    assert store.n_shards > 1
    rows = sorted(token_files.documents_of(store).collect(), key=lambda r: r["start"])
    want = Counter((r[0], len(ids := [*plain_ids(r[1]), 1]), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in corpus)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is None, k or 0))
    assert max(Counter(r["shard"] for r in rows).values()) < len(rows)
    strange = spark.createDataFrame([(10**9 + i, 0) for i in range(500)] + [(3, 0), (3, 7)], "key long, occurrence long")
    assert [r["key"] for r in token_files.lookup(store, strange).collect()] == [3]
    assert token_files.documents_of(token_files.write_store(empty)).count() == 0


def test_store_splits_hot_ids_and_keeps_the_order_of_rows(spark, tmp_path):
    texts = [(None, f"text number {i % 7} of many") for i in range(300)] + [(5, "the very same text") for _ in range(300)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    store = token_files.write_store(d, shard_bytes=4000)
    rows = token_files.documents_of(store).collect()
    by = Counter(r["shard"] for r in rows)
    assert len(by) >= 10 and max(by.values()) < 120
    assert Counter((r["doc_id"], r["occurrence"]) for r in rows) == Counter([(None, i) for i in range(300)] + [(5, i) for i in range(300)])
    mixed = [(i * 37 % 101, f"w{i} " * (i % 5 + 1)) for i in range(200)]
    spark.createDataFrame(mixed, "doc_id long, text string").repartition(3).write.parquet(f"file://{tmp_path}/t")
    t = spark.read.parquet(f"file://{tmp_path}/t")
    order = []
    for f in sorted(t.inputFiles()):
        order += [(r["doc_id"], len(plain_ids(r["text"])) + 1) for r in spark.read.parquet(f).coalesce(1).collect()]
    for source in (t, t.orderBy("text", "doc_id")):
        got = sorted(token_files.documents_of(token_files.write_store(source, shard_bytes=3000, order="rows")).collect(), key=lambda r: r["start"])
        want = order if source is t else [(r["doc_id"], len(plain_ids(r["text"])) + 1) for r in source.collect()]
        assert [(r["doc_id"], r["n_tokens"]) for r in got] == want
        assert [r["start"] for r in got] == np.cumsum([0, *(n for _, n in want)])[:-1].tolist()


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        a, b = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, n).astype(np.uint64)
        mph = token_files.PerfectHash.build(a, b)
        assert sorted(mph.slots(a, b).tolist()) == list(range(n))
        back, table = token_files.open_index(token_files.pack_index(a, b, np.zeros(n), np.arange(n), np.ones(n)))
        assert table["offset"][back.slots(a, b)].tolist() == list(range(n))


@pytest.mark.parametrize("block", [2, 10, 128, 10**6])
def test_separator_scan(spark, tmp_path, block):
    rng = np.random.default_rng(5)
    want = []
    for k, n in enumerate((0, 1, 50, 700)):
        a = rng.integers(0, 9, n).astype("<u2")
        if k == 3:
            a[100:400] = 5  # one document over many blocks
        a.tofile(tmp_path / f"f{k}.ids")
        start = ordinal = 0
        for i in np.flatnonzero(a == 0).tolist():
            want.append((f"f{k}.ids", ordinal, start, i + 1 - start, True))
            start, ordinal = i + 1, ordinal + 1
        if start < n:
            want.append((f"f{k}.ids", ordinal, start, n - start, False))
    assert sorted(map(tuple, token_counts.count_tokens(spark, f"file://{tmp_path}", 0, block_bytes=block).collect())) == sorted(want)
    (tmp_path / "odd.ids").write_bytes(b"abc")
    with pytest.raises(ValueError, match="whole ids"):
        token_counts.count_tokens(spark, f"file://{tmp_path}", 0)


def test_document_counts(corpus, docs, empty):
    got = Counter((r["doc_id"], r["n_tokens"]) for r in token_counts.document_counts(docs).collect())
    assert got == Counter((r[0], len(plain_ids(r[1], True)) + 1) for r in corpus)
    assert token_counts.document_counts(empty).count() == 0


def test_counts_do_not_follow_the_cores(spark, corpus, docs, tmp_path):
    docs.repartition(5).write.parquet(f"file://{tmp_path}/d")
    d = spark.read.parquet(f"file://{tmp_path}/d")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
    try:
        lazy = [token_counts.document_counts(d), mixing.taken(mixing.mix(d, block=16)), mixing.mixed_documents(d), repeated_bytes.remove_repeats(d)]
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "8")
        few = [x.collect() for x in lazy]
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert Counter((r["doc_id"], r["n_tokens"]) for r in few[0]) == Counter((r[0], len(plain_ids(r[1], True)) + 1) for r in corpus)
    assert sorted(map(tuple, few[1]), key=str) == sorted(map(tuple, mixing.taken(mixing.mix(docs, block=16)).collect()), key=str)
    assert Counter(r["doc_id"] for r in few[2]) == Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    assert Counter((r["doc_id"], r["n_removed"]) for r in few[3]) == Counter((r["doc_id"], r["n_removed"]) for r in repeated_bytes.remove_repeats(docs).collect())


# --- URL filters ---

RULES = (urls.Rule("org", "/", True), urls.Rule("example.org", "/es/", False), urls.Rule("com", "/de/", False))


def test_urls(spark):
    pages = [
        (1, "HTTP://A.Example.ORG/es/1?x#y", '<a href="http://far.net/">'),
        (2, "http://example.org/en", None),
        (3, None, ""),
        (4, "no scheme", None),
        (5, "https://b.com/de/x", '<a HREF=//near.net/p>'),
        (6, "http://near.net/", None),
        (7, "http://linker.net#f", "<a href='http://b.com/1'><a href=\"http://me@B.com:80/\">"),
        (8, "http://far.net?q", None),
        (9, "http://org", None),
        (9, "http://notorg.x/?://a", None),
        (10, "http://ok.org/p", '<a href="http://far.net/1"><a href="http://far.net/2">'),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit(1), "links": F.lit(2), "verdict": F.lit("x")})
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(df, RULES).collect()), key=str)
    assert got == sorted(
        [
            (1, "a.example.org", "/es/1", "example.org/es/", "block"),
            (2, "example.org", "/en", "org/", "allow"),
            (3, "", "", None, "allow"),
            (4, "", "", None, "allow"),
            (5, "b.com", "/de/x", "com/de/", "block"),
            (6, "near.net", "/", None, "allow"),
            (7, "linker.net", "", None, "block"),
            (8, "far.net", "", None, "allow"),
            (9, "org", "", None, "allow"),
            (9, "notorg.x", "/", None, "allow"),
            (10, "ok.org", "/p", "org/", "allow"),
        ],
        key=str,
    )
    assert urls.judge_urls(df.limit(0), RULES).count() == 0


def test_trust_equals_dense_page_rank(spark):
    rng = random.Random(8)
    hosts = [f"h{i}" for i in range(8)]
    edges = sorted({(rng.choice(hosts), rng.choice(hosts[:6]), rng.randint(1, 3)) for _ in range(16)})
    edges = list({(a, b): (a, b, n) for a, b, n in edges if a != b}.values())
    pages = [("h0", "allow"), ("h0", "allow"), ("h1", "allow"), ("h2", "block"), ("h3", None)]
    trust = urls.TrustRules(tolerance=1e-3)
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urls.host_trust(spark.createDataFrame(pages, "host string, verdict string"), spark.createDataFrame(edges, "source string, target string, n long"), trust).collect()}

    def dense(seed, back):
        m, s = np.zeros((8, 8)), np.array([seed.get(h, 0) for h in hosts], float)
        for a, b, n in edges:
            i, j = hosts.index(a), hosts.index(b)
            m[(i, j) if back else (j, i)] += n
        out = m.sum(0)
        m = m / np.where(out > 0, out, 1)
        s, x = s / s.sum(), s / s.sum()
        for _ in range(200):
            y = m @ x
            x = 0.85 * (y + (1 - y.sum()) * s) + 0.15 * s
        return x

    good, bad = 3 * dense({"h0": 2, "h1": 1}, False), dense({"h2": 1}, True)
    for i, h in enumerate(hosts):
        assert got.get(h, (0, 0)) == (pytest.approx(good[i], abs=0.02), pytest.approx(bad[i], abs=0.02))


def test_equal_trust_allows_and_rounds_end(spark):
    pages = [(1, "http://x.org/", ""), (2, "http://x.org/bad/", ""), (3, "http://x.org/none", ""), (4, "http://x.net/", '<a href="http://x.org">')]
    rules = (urls.Rule("x.org", "/a", True), urls.Rule("x.org", "/bad/", False), urls.Rule("x.org", "/none", True))
    df = spark.createDataFrame([*pages, (5, "http://x.org/other", None)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(df, rules, urls.TrustRules(tolerance=0.01)).collect()}
    assert got[1] == got[5] == "allow" and got[2] == "block" and got[4] == "block"
    with pytest.raises(RuntimeError, match="still changes"):
        urls.judge_urls(df, rules, urls.TrustRules(rounds=1)).collect()


# --- quality classifier ---


def test_votes_equal_brute_force():
    """Cosines with every labelled vector, sorted: the nearest, of equal ones the earlier in the sample."""
    rng = random.Random(10)
    texts = [(prose(rng, 30) if i % 3 else prose(rng, 30).upper()).encode() for i in range(90)]
    texts += texts[:30]  # copies with other labels: ties
    labels = np.array([float(i % 3 > 0) if i < 90 else float(i % 2) for i in range(120)])
    rules = knn_quality.VoteRules(neighbours=7, dims=12)
    votes = knn_quality.Votes.fit(np.stack([knn_quality.features(t) for t in texts]), labels, rules)
    probes = [*texts[:40], *(prose(rng, 40).encode() for _ in range(20)), b"", None]
    got = votes.score(probes)
    for t, score in zip(probes, got, strict=True):
        v = (knn_quality.features(t) * votes.idf) @ votes.axes
        if not t:
            assert score == votes.empty
            continue
        v = v / np.linalg.norm(v)
        like = [round(float(x), 6) for x in votes.vectors @ v]
        near = sorted(range(len(like)), key=lambda i: (-like[i], i))[:7]
        w = [max(like[i], 1e-6) ** rules.sharpness * float(votes.weights[i]) for i in near]
        assert score == pytest.approx(sum(a * labels[i] for a, i in zip(w, near, strict=True)) / sum(w), abs=2e-4)
    assert got[0] == votes.score(texts[90:91])[0]


def test_features_of_long_texts_come_in_pieces(monkeypatch):
    rng = random.Random(12)
    texts = [prose(rng, 300).replace("a ", "a\n").encode(), b"x" * 500, b" \n ", b"a", b"  two words", "é ü".encode() * 50]
    whole = [knn_quality.features(t) for t in texts]
    monkeypatch.setattr(knn_quality, "_PIECE", 64)
    for t, x in zip(texts, whole, strict=True):
        assert np.allclose(knn_quality.features(t), x)


def test_votes(spark, docs, empty):
    rng = random.Random(9)
    good = [(i, prose(rng, 60).capitalize() + ".", 1) for i in range(120)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(rng, 60).split()), 0) for i in range(60)]
    d = spark.createDataFrame([(i, t) for i, t, _ in good + bad] + [(5000, None), (5001, "")], "doc_id long, text string")
    lab = spark.createDataFrame([(i, y, 0) for i, _, y in good + bad] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in knn_quality.classify(d, lab).collect()}
    test = [(i, y) for i, _, y in good + bad if zlib.crc32(str(i).encode()) % 5 == 0]
    assert test and all(got[i]["held_out"] and got[i]["predicted"] == y for i, y in test)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[5000]["score"] == got[5001]["score"] == 0.0
    assert {r["score"] for r in knn_quality.classify(d.limit(5), lab.limit(0)).collect()} == {0.5}
    assert knn_quality.classify(docs, lab).count() == docs.count() and knn_quality.classify(empty, lab).count() == 0


# --- preference formatting ---


def test_preferences(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "why?"), (1, 3, "assistant", "because"), (1, 3, "assistant", "because"), (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "alone"), (4, 0, "assistant", "first"), (None, 0, "user", "x"), (5, 1, "assistant", None), (5, 0, None, "q"), (6, None, "user", "n"), (6, 1, "assistant", "a")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({"id": F.lit(9), "turns": F.lit(1), "chosen": F.lit("c")})
    got = {r["id"]: r for r in preferences.format_preferences(preferences.reply_pairs(df)).collect()}
    assert set(got) == {1, 2, 5, 6}
    pick = int(hashlib.md5(b"1").hexdigest()[:8], 16) % 2
    assert got[1]["n_common_turns"] == (1, 3)[pick]
    whole = ["<user>\nhi\n<end>\n", "<assistant>\nhello\n<end>\n", "<user>\nwhy?\n<end>\n", "<assistant>\nbecause\n<end>\n"]
    other = [*whole]
    other[1 + 2 * pick] = "<assistant>\n" + ("hi", "why?")[pick] + "\n<end>\n"
    n = got[1]["n_common_turns"]
    assert (got[1]["prompt"], got[1]["chosen"], got[1]["rejected"]) == ("".join(whole[:n]), "".join(whole[n:]), "".join(other[n:]))
    for side in ("chosen", "rejected"):
        mask = "".join(x[0] * int(x[2:]) for x in got[1][f"{side}_mask"].split())
        assert len(mask) == len(got[1][side]) and mask.count("1") == got[1][f"{side}_loss"]
    assert (got[1]["usable"], got[2]["usable"], got[2]["n_common_turns"], got[2]["chosen"], got[2]["chosen_mask"]) == (True, False, 2, "", "")
    assert got[5]["chosen"] == "<assistant>\n\n<end>\n"
    pairs = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b"), ("user", "c")], [("user", "a"), ("assistant", "x")]), (2, [], [("user", "a")])], "id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    formatted = preferences.format_preferences(pairs)
    row = preferences.encode_preferences(formatted, vocabulary_path()).collect()
    assert len(row) == 1
    r = row[0]
    assert r["prompt_ids"] == plain_ids("<user>\na\n<end>\n", True)
    head, body, rest = plain_ids("<assistant>\n"), plain_ids("b\n<end>\n"), plain_ids("<user>\nc\n<end>\n")
    assert r["chosen_ids"] == head + body + rest and r["chosen_mask"] == [0] * len(head) + [1] * len(body) + [0] * len(rest)
    assert preferences.format_preferences(preferences.reply_pairs(df.limit(0))).count() == 0


# --- the pipeline ---


def test_pipeline(spark, docs, empty, tmp_path):
    rng = random.Random(21)
    item = prose(rng, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(i, prose(rng, 80), "en", "s0", 1) for i in range(20)]
    planted = [(100, clean[0][1]), (101, clean[1][1] + " " + item), (102, "spam spam spam spam spam " * 20), (103, "too short")]
    rows = clean + [(i, t, "en", "s1", 1) for i, t in planted]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    at, left = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.materialize(stage(spark, at, str(tmp_path)), "t")
        assert at.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left.append({r["doc_id"] for r in at.collect()})
    every = {i for i, *_ in clean}
    assert left[0] == every | {100, 101} and left[1] == every | {101} and left[2] == every and left[3] <= every
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == left[3]
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None

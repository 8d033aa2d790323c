"""Removal of byte strings that occur twice in a corpus, by column-wise suffix sorting of a collection.

All documents are seen as UTF-8 bytes. A string of ``length`` bytes that starts at two places, in one
document or in two, is removed at both, judged on the input.

1. *Cutting.* Of the ``anchor``-byte strings inside each window of ``length`` bytes the one with the
   smallest hash, leftmost on ties, is the window's anchor. Equal windows have equal anchors at equal
   places, so windows are cut into segments that share an anchor occurrence, and segments whose
   anchor occurs once in the corpus cannot hold a repeat: they go no further than a (key, place) row.
2. *Collecting.* The other segments are cut out of the texts; equal ones become one with a count, so
   a group of copies of any size is one member of the collection. Members are dealt to bins by their
   anchor; the number of bins follows their bytes. The members of an anchor that alone has more bytes
   than a bin (some text in front of or behind a very common passage, say, different in each document)
   are not dealt to a bin: each of their windows becomes a row with its 128-bit hash, and equal hashes
   are counted by an ordinary aggregation. That is exact like the rest, and no task holds them all.
3. *Construction.* In a bin all members are aligned on their anchor. From the last column to the
   first, each round puts one symbol in front of every member's suffix: the symbols, in suffix order,
   are the column's Burrows-Wheeler transform, a stable counting sort of it gives the order of the
   longer suffixes, and the common prefix with the predecessor becomes one more than the smallest one
   since the previous member with the same symbol. Equal windows can only start in one column, so
   columns are never interleaved: a round reads and writes one entry per member, strictly in order,
   and the whole costs time linear in the bytes of the bin. Windows whose common prefix with a
   neighbour reaches ``length`` repeat, and so do those of members counted twice.
4. *Removal.* The repeating windows of each member go back to its occurrences, are united per
   document and cut out of its text.

The segments, places and runs between these steps are sequential files in the shared folder.

Null texts count as empty. Texts shorter than ``length`` are kept whole. Repeated rows are copies of
one another like any others. What is left of a text is bytes: a removed run may begin inside a
character. Input columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_TASKS, RID, discard, materialize, small_batches, stable_rows, tasks_for

ANCHOR = 48
BIN_BYTES = 16 << 20
_CHUNK = 1 << 20  # window starts hashed at once
_PLACE = np.uint64(0xFFFFFF)


def anchors(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts with one anchor occurrence: key, anchor's place, first start, starts."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    parts = []
    for begin in range(0, n, _CHUNK):
        b = data[begin : begin + min(_CHUNK, n - begin) + length - 1]
        # hashes of all strings of anchor bytes, by doubling
        h = (b.astype(np.uint64) + np.uint64(0x51)) * np.uint64(0x9E3779B97F4A7C15)
        got, have, rest = None, 0, anchor
        size = 1
        while rest:
            if rest & 1:
                if got is None:
                    got, have = h, size
                else:
                    k = min(len(got), len(h) - have)
                    got = got[:k] * np.uint64(0xC2B2AE3D27D4EB4F) + h[have : have + k]
                    got ^= got >> np.uint64(29)
                    have += size
            rest >>= 1
            if rest:
                h = h[:-size] * np.uint64(0xBF58476D1CE4E5B9) + h[size:]
                h ^= h >> np.uint64(31)
                size *= 2
        got = got[: len(b) - anchor + 1] * np.uint64(0x94D049BB133111EB)
        got ^= got >> np.uint64(32)
        # the smallest of each window, by doubling; the place in the low bits breaks ties to the left
        v = (got & ~_PLACE) | np.arange(len(got), dtype=np.uint64)
        w, size = length - anchor + 1, 1
        while 2 * size <= w:
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        if size < w:
            v = np.minimum(v[: len(v) - (w - size)], v[w - size :])
        place = (v & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        count = np.diff(np.append(first, len(place)))
        at = place[first]
        parts.append((got[at].view(np.int64), at + begin, first + begin, count))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def repeating_starts(members: list[bytes], before: np.ndarray, starts: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """For each member (row) and start column, whether its window there is also another member's.

    before: bytes of each member ahead of its anchor; starts: its number of window starts.
    """
    m, last = len(members), length - anchor
    width = last + length
    begin = last - before  # the column of the first start
    stop = begin + starts + length - 1
    rows = b"".join((bytes(c) + x).ljust(width, b"\0") for c, x in zip(begin.tolist(), members, strict=True))
    columns = np.ascontiguousarray(np.frombuffer(rows, np.uint8).reshape(m, width).T)
    del rows
    out = np.zeros((last + 1, m), bool)
    order, common = np.zeros(0, np.int32), np.zeros(0, np.int16)
    joins = np.argsort(stop, kind="stable").astype(np.int32)
    upto = np.searchsorted(stop[joins], np.arange(width + 2))
    for t in range(width - 1, -1, -1):
        new = joins[upto[t + 1] : upto[t + 2]]  # members that end here: an empty suffix comes first
        if len(new):
            order = np.concatenate((new, order))
            common = np.concatenate((np.zeros(len(new), np.int16), common))
        if t < last and len(order):
            alive = np.flatnonzero(begin[order] <= t)
            if len(alive) < len(order):
                if not len(alive):
                    order, common = order[:0], common[:0]
                    continue
                common = np.minimum.reduceat(common[: alive[-1] + 1], np.concatenate(([0], alive[:-1] + 1)))
                order = order[alive]
                common[0] = 0
        if not len(order):
            continue
        symbols = columns[t][order]  # the transform of this column
        by = np.argsort(symbols, kind="stable")
        ordered = symbols[by]
        same = np.flatnonzero(ordered[1:] == ordered[:-1])
        longer = np.zeros(len(order), np.int16)
        if len(same):
            spans = np.empty(2 * len(same), np.int64)
            spans[::2] = by[same] + 1
            spans[1::2] = by[same + 1] + 1
            longer[same + 1] = np.minimum.reduceat(np.append(common, np.int16(0)), spans)[::2] + 1
        order, common = order[by], longer
        if t <= last:
            hit = common >= length
            hit[:-1] |= hit[1:]
            hit &= (begin[order] <= t) & (t < begin[order] + starts[order])
            out[t, order[hit]] = True
    return out


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first columns and lengths of the runs of a boolean matrix."""
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    return row, first, stop - first


def repeated_spans(rows: DataFrame, length: int = 200, anchor: int = ANCHOR, bin_bytes: int = BIN_BYTES, text_col: str = "text") -> DataFrame:
    """(RID, spans): for each row with a repeat, arrays of begin and stop of its repeating windows' unions, unsorted and overlapping.

    rows: as ``stable_rows`` gives them.
    """
    spark = rows.sparkSession
    small_batches(spark)
    texts = rows.select(RID, F.col(f"`{text_col}`").cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text and len(text) >= length:
                    got = anchors(np.frombuffer(text, np.uint8), length, anchor)
                    found.append((np.full(len(got[0]), rid, np.int64), *got))
            if found:
                rid, key, at, first, n = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(key), pa.array((at - first).astype(np.int32)), pa.array(first), pa.array(n.astype(np.int32))], [RID, "key", "before", "first", "n"])

    places = materialize(texts.mapInArrow(cut, f"{RID} long, key long, before int, first long, n int"), "places")
    # written first: a join that shares the sum's shuffle could not split a hot key
    twice = materialize(places.groupBy("key").agg(F.count(F.lit(1)).alias("__c")).filter("__c > 1").select("key"), "keys")
    wanted = places.join(twice, "key", "left_semi")
    piece = F.substring("text", F.col("first").cast("int") + 1, F.col("n") + F.lit(length - 1))
    segments = wanted.join(texts, RID).select(RID, "key", "before", "first", "n", piece.alias("segment"))
    segments = materialize(segments.withColumns({"s1": F.xxhash64("segment"), "s2": F.xxhash64(F.lit("veedor"), "segment", "before")}), "segments")
    discard(places, twice)

    members = materialize(segments.groupBy("key", "s1", "s2", "before", "n", "segment").agg(F.count(F.lit(1)).alias("copies")), "members")
    size = F.octet_length("segment").cast("long")
    total = members.agg(F.sum(size)).first()[0] or 0
    bins = tasks_for(total, bin_bytes)
    most = max(bin_bytes, total // MOST_TASKS)
    hot = materialize(members.groupBy("key").agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > most).select("key"), "hot")
    last = length - anchor

    def construct(table: pa.Table) -> pa.Table:
        before, n = np.asarray(table["before"]).astype(np.int64), np.asarray(table["n"]).astype(np.int64)
        mask = repeating_starts(table["segment"].to_pylist(), before, n, length, anchor).T
        column = np.arange(last + 1)
        many = np.asarray(table["copies"]) > 1
        begin = (last - before)[:, None]
        mask |= many[:, None] & (column >= begin) & (column < begin + n[:, None])
        row, first, size = _runs(mask)
        s1, s2 = np.asarray(table["s1"])[row], np.asarray(table["s2"])[row]
        return pa.table({"s1": s1, "s2": s2, "skip": (first - begin[row, 0]).astype(np.int32), "size": size.astype(np.int32)})

    dealt = members.join(hot, "key", "left_anti").withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(bins)).cast("int"))
    runs = dealt.groupBy("bin").applyInArrow(construct, "s1 long, s2 long, skip int, size int")
    # the windows of hot anchors, a row each
    window = members.join(hot, "key", "left_semi").select("s1", "s2", "copies", "segment", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("skip"))
    window = window.withColumn("w", F.substring("segment", F.col("skip") + 1, F.lit(length))).select("s1", "s2", "copies", "skip", F.xxhash64("w").alias("w1"), F.xxhash64(F.lit("veedor"), "w").alias("w2"))
    count = materialize(window.groupBy("w1", "w2").agg(F.sum("copies").alias("m")).filter("m > 1").select("w1", "w2"), "windows")
    alone = window.join(count, ["w1", "w2"], "left_semi").select("s1", "s2", "skip", F.lit(1).alias("size"))
    runs = materialize(runs.unionByName(alone), "runs")
    discard(members, hot, count)
    begin = F.col("first") + F.col("skip")
    spans = segments.drop("segment").join(runs, ["s1", "s2"]).select(RID, begin.alias("begin"), (begin + F.col("size") + F.lit(length - 1)).alias("stop"))
    return spans.groupBy(RID).agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, **how) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and, on request, ``spans`` (sorted and disjoint) and ``kept``, the bytes left."""
    small_batches(docs.sparkSession)
    rows = stable_rows(docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text")))
    spans = materialize(repeated_spans(rows, length, **how), "spans")
    extra = ", spans array<struct<begin: long, stop: long>>, kept binary" if with_text else ""
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, pairs in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                merged: list[list[int]] = []
                for a, b in sorted((p["begin"], p["stop"]) for p in pairs):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                at, left = 0, []
                for a, b in merged:
                    left.append(text[at:a])
                    at = b
                left.append(text[at:])
                kept = b"".join(left)
                out.append((len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), [{"begin": a, "stop": b} for a, b in merged], kept))
            cols = list(zip(*out, strict=True)) or [()] * 5
            arrays = [batch.column(RID), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())]
            names = [RID, "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays += [pa.array(cols[3], kind), pa.array(cols[4], pa.binary())]
                names += ["spans", "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    cut = rows.select(RID, "text").join(spans, RID).mapInArrow(strip, f"{RID} long, n_removed long, n_spans long, kept_sha256 string{extra}")
    whole = [RID, "id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")]
    out = rows.select(*whole, *([F.col("text").alias("all")] if with_text else [])).join(cut, RID, "left")
    zero = F.lit(0).cast("long")
    cols = [F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")]
    if with_text:
        cols += [F.coalesce("spans", F.array().cast("array<struct<begin: bigint, stop: bigint>>")).alias("spans"), F.coalesce("kept", "all").alias("kept")]
    return out.select(*cols)

"""Benchmark decontamination: rare word n-grams as seeds, Smith-Waterman alignment as the judge.

The benchmark is a query set held against all documents, in blocks of at most ``block_bytes`` of
text; a block is the only thing sent to the workers. For each block, a first pass over the documents
counts in how many of them each of its n-grams occurs. A second pass places the seeds: a diagonal
band of a document goes on to alignment if it shares a rare n-gram with an item, one that at most
``rare_share`` of all documents hold, or two different n-grams of any frequency, so a passage that
has become common by being copied is still found. The words around the band are aligned locally with
the item (match 2, mismatch and gap -1); the similarity is the score over the best one possible.

An alignment stays within a band of diagonals around its seeds: half the item's words to either side,
``max_slack`` words at most, so the cost of a long item grows with its length and not with its square.
Seeds are grouped by document, item and band a bounded number at a time, and alignments are batched by
their cells, so memory is bounded by the block whatever the texts and items hold.

Words are runs of anything but white space and ASCII punctuation, in lower case. An item with fewer
than ``n`` words is its own seed: it matches where all of it occurs, if it is rare. Items without a
word, null and empty texts match nothing. Items with null ids are aligned like others. Repeated rows
and repeated items are judged on their own; of equal alignments the first in the document counts.
Other columns are ignored by ``leaks`` and kept by ``drop_leaks``. An empty table on either side gives
no leaks. Ids can be of any type that Arrow has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import small_batches

_BLANK = bytes(32 if i < 128 and not chr(i).isalnum() else i for i in range(256))
_CELLS = 1 << 20  # of a step of alignments, all together
_SEEDS = 1 << 20  # places of seeds in items, grouped at once


@dataclass(frozen=True)
class LeakRules:
    n: int = 3
    rare_share: float = 0.001
    min_similarity: float = 0.5
    max_slack: int = 512
    block_bytes: int = 16 << 20


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_BLANK).split() if text else []


class _Numbers(dict):
    def __missing__(self, key):
        return -1


class Block:
    """The n-grams of some items, and the items as numbers."""

    def __init__(self, ids: list, texts: list[str | None], n: int):
        self.ids, self.n = ids, n
        self.numbers = _Numbers()
        self.items = [np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words_of(t)], np.int64) for t in texts]
        self.size = np.array([len(x) for x in self.items], np.int64)
        self.lengths = sorted({min(n, k) for k in self.size.tolist() if k})  # of seeds
        self.base = len(self.numbers) + 1
        if self.base**n * (n + 1) >= 2**64:
            raise ValueError("a block has too many different words for its n-grams to be told apart: use smaller blocks")
        key, item, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, x in enumerate(self.items):
            if len(x):
                k = self.keys(x, min(n, len(x)))
                key.append(k)
                item.append(np.full(len(k), i))
                at.append(np.arange(len(k)))
        self.key = np.concatenate(key)
        by = np.argsort(self.key, kind="stable")
        self.key, self.item, self.at = self.key[by], np.concatenate(item)[by], np.concatenate(at)[by]
        self.grams, self.first, self.count = np.unique(self.key, return_index=True, return_counts=True)

    def keys(self, x: np.ndarray, m: int) -> np.ndarray:
        """A number for the gram of m words at each place; different grams have different numbers."""
        places = max(0, len(x) - m + 1)
        out = np.full(places, m, np.uint64)
        for k in range(m):
            out = out * np.uint64(self.base) + (x[k : k + places] + 1).astype(np.uint64)
        return out

    def seeds(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of all texts as numbers, where each text starts, and the places and indices of grams that the block has, by place."""
        find = self.numbers.__getitem__
        all_: list[int] = []
        starts = []
        for t in texts:
            starts.append(len(all_))
            all_.extend(map(find, words_of(t)))
            all_.append(-1)
        x = np.array(all_, np.int64)
        places, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for m in self.lengths:
            known = np.append(0, np.cumsum(x < 0))
            place = np.flatnonzero(known[m:] == known[: len(known) - m])
            key = self.keys(x, m)[place]
            gram = np.minimum(np.searchsorted(self.grams, key), len(self.grams) - 1)
            hit = self.grams[gram] == key
            places.append(place[hit])
            grams.append(gram[hit])
        place, gram = np.concatenate(places), np.concatenate(grams)
        by = np.argsort(place, kind="stable")
        return x, np.array(starts), place[by], gram[by]


def align(items: np.ndarray, sizes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Local alignment of each row of items (its first ``sizes`` numbers) with its window: score, and where it ends in the window and the item (exclusive).

    Word i of the item meets words i, ..., i + band of the window; the band is what the windows are wider than the items.
    """
    p, band = len(windows), windows.shape[1] - items.shape[1] + 1
    j = np.arange(band, dtype=np.int32)
    h = np.zeros((p, band + 1), np.int32)  # the last column is beyond the band
    best, end, item_end = np.zeros(p, np.int32), np.zeros(p, np.int64), np.zeros(p, np.int64)
    for i in range(items.shape[1]):
        s = np.where(windows[:, i : i + band] == items[:, i, None], 2, -1).astype(np.int32)
        row = np.maximum(h[:, :-1] + s, h[:, 1:] - 1)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + j, axis=1) - j
        h[:, :-1] = row
        at = row.argmax(1)
        top = row[np.arange(p), at]
        up = (top > best) & (i < sizes)
        best[up], end[up], item_end[up] = top[up], i + at[up] + 1, i + 1
    return best, end, item_end


def _grouped(keys: list[np.ndarray], low: np.ndarray, high: np.ndarray, rare: np.ndarray) -> list[np.ndarray]:
    """One row for each combination of keys: the lowest and highest place in the item, and whether any seed is rare."""
    if not len(low):
        return [*keys, low, high, rare]
    by = np.lexsort(keys[::-1])
    keys = [k[by] for k in keys]
    differs = np.zeros(len(low) - 1, bool)
    for k in keys:
        differs |= k[1:] != k[:-1]
    new = np.flatnonzero(np.concatenate(([True], differs)))
    return [*(k[new] for k in keys), np.minimum.reduceat(low[by], new), np.maximum.reduceat(high[by], new), np.logical_or.reduceat(rare[by], new)]


def _candidates(block: Block, rare: np.ndarray, starts: np.ndarray, place: np.ndarray, gram: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Rows (text, item, lowest diagonal) of the bands that are worth an alignment.

    A band is worth it with a rare seed, or with seeds at two places of the item. Seeds of a place are
    unfolded to the items that have them, a bounded number of them at a time, texts in order.
    """
    text = np.searchsorted(starts, place, "right") - 1
    upto = np.cumsum(block.count[gram])
    out, open_ = [], None
    begin = 0
    while begin < len(place):
        done = upto[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(upto, done + _SEEDS, "right")))
        many = block.count[gram[begin:stop]]
        offset = np.repeat(block.first[gram[begin:stop]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        item, at = block.item[offset], block.at[offset]
        t, g = np.repeat(text[begin:stop], many), np.repeat(gram[begin:stop], many)
        diagonal = np.repeat(place[begin:stop], many) - at - starts[t] + (1 << 40)
        whole = rare[g] & (block.size[item] < block.n)
        some = rare[g] & (block.size[item] >= block.n) | whole
        fits = (block.size[item] >= block.n) | whole
        rows = []
        for half in (0, 1):  # bands twice, so that near seeds share one
            low = (diagonal + half * (slack[item] // 2)) // slack[item] * slack[item] - half * (slack[item] // 2) - (1 << 40)
            rows.append([t[fits], item[fits], low[fits], at[fits], at[fits], some[fits]])
        if open_ is not None:
            rows.append(open_)
        rows = [np.concatenate(c) for c in zip(*rows, strict=True)]
        rows = _grouped(rows[:3], *rows[3:])
        last = rows[0] == text[stop - 1] if stop < len(place) else np.zeros(len(rows[0]), bool)  # this text may go on
        open_ = [c[last] for c in rows]
        go = ~last & (rows[5] | (rows[4] > rows[3]))
        out.append(np.stack([c[go] for c in rows[:3]], axis=1))
        begin = stop
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def block_leaks(block: Block, rare: np.ndarray, texts: list[str | None], rules: LeakRules) -> list[tuple]:
    """(text, item, score, begin, end) of the best alignment of each text and item that is similar enough; begin and end in words of the text."""
    x, starts, place, gram = block.seeds(texts)
    if not len(place):
        return []
    size = block.size
    slack = np.clip(size // 2, 8, rules.max_slack)
    pairs = _candidates(block, rare, starts, place, gram, slack)
    pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 0], pairs[:, 1], size[pairs[:, 1]]))]
    stops = np.append(starts[1:], len(x)) - 1
    best: dict[tuple[int, int], tuple] = {}
    k = 0
    while k < len(pairs):
        # pairs go by size: as many as fit with the largest one's width
        more = size[pairs[k:, 1]]
        cells = np.arange(1, len(more) + 1) * (more + 4 * slack[pairs[k:, 1]] + 1)
        part = pairs[k : k + max(1, int(np.searchsorted(cells, _CELLS, "right")))]
        k += len(part)
        sizes, spare = size[part[:, 1]], slack[part[:, 1]]
        long_, band = int(sizes.max()), int(4 * spare.max())
        items = np.full((len(part), long_), -2, np.int64)
        windows = np.full((len(part), long_ + band), -1, np.int64)
        froms = np.zeros(len(part), np.int64)
        for r, (t, i, low) in enumerate(part.tolist()):
            items[r, : sizes[r]] = block.items[i]
            first = low - int(spare[r]) + int(starts[t])  # the window's first word, maybe before the text
            begin, stop = max(first, int(starts[t])), min(int(stops[t]), first + long_ + band)
            if begin < stop:
                windows[r, begin - first : stop - first] = x[begin:stop]
            froms[r] = first - int(starts[t])
        score, end, item_end = align(items, sizes, windows)
        ok = np.flatnonzero((score >= rules.min_similarity * 2 * sizes) & (score > 0) & ((sizes >= block.n) | (score == 2 * sizes)))
        if not len(ok):
            continue
        # the same alignment backwards from its end finds where it begins
        widest, side = int(item_end[ok].max()), band
        back = np.full((len(ok), widest), -2, np.int64)
        seen = np.full((len(ok), widest + 2 * side), -1, np.int64)
        for r, q in enumerate(ok.tolist()):
            back[r, : item_end[q]] = items[q, : item_end[q]][::-1]
            ahead = windows[q, max(0, end[q] - widest - side) : end[q]][::-1]
            seen[r, side : side + len(ahead)] = ahead
        _, length, _ = align(back, item_end[ok], seen)
        for q, n in zip(ok.tolist(), (length - side).tolist(), strict=True):
            t, i, _ = part[q].tolist()
            stop = int(froms[q] + end[q])
            got = (int(score[q]), stop - int(n), stop)
            old = best.get((t, i))
            if old is None or (-got[0], got[1]) < (-old[0], old[1]):
                best[t, i] = got
    return [(t, i, *v) for (t, i), v in best.items()]


def _blocks(items: DataFrame, item_id: str, item_text: str, rules: LeakRules) -> Iterator[Block]:
    ids, texts, size = [], [], 0
    for row in items.select(F.col(f"`{item_id}`"), F.col(f"`{item_text}`")).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len((row[1] or "").encode("utf-8", "replace"))
        if size >= rules.block_bytes:
            yield Block(ids, texts, rules.n)
            ids, texts, size = [], [], 0
    if ids:
        yield Block(ids, texts, rules.n)


def _with_rarity(docs: DataFrame, items: DataFrame, rules: LeakRules, text_col: str, item_id: str, item_text: str):
    """Each block of items, broadcast, with the mask of its rare n-grams."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    total = None
    for block in _blocks(items, item_id, item_text, rules):
        total = docs.count() if total is None else total
        sent = spark.sparkContext.broadcast(block)  # of bounded size

        def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            n = np.zeros(len(block.grams), np.int64)
            for batch in batches:
                _, starts, place, gram = block.seeds(batch.column(0).to_pylist())
                if len(place):
                    text = np.searchsorted(starts, place, "right") - 1
                    n += np.bincount(np.unique(text * len(n) + gram) % len(n), minlength=len(n))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["gram", "n"])

        found = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
        often = np.zeros(len(block.grams), np.int64)
        for gram, n in found:  # no more rows than the block has n-grams
            often[gram] = n
        yield block, sent, often <= max(1.0, rules.rare_share * total)


def leaks(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that it holds a copy of: ids, similarity, and begin and end of the copy in words of the document."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType
    item_type = to_arrow_type(item_kind)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = f"`{id_col}` {kind}, `{item_id}` {item_kind.simpleString()}, similarity double, doc_begin long, doc_end long"
    out = None
    for _, sent, rare in _with_rarity(docs, items, rules, text_col, item_id, item_text):

        def place(batches: Iterator[pa.RecordBatch], sent=sent, rare=rare) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in batches:
                rows = block_leaks(block, rare, batch.column(1).to_pylist(), rules)
                likeness = [r[2] / (2 * int(block.size[r[1]])) for r in rows]
                cols = [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([block.ids[r[1]] for r in rows], item_type), pa.array(likeness, pa.float64()), pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, [id_col, item_id, "similarity", "doc_begin", "doc_end"])

        part = texts.mapInArrow(place, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without those that hold a copy of an item, all columns as they are. Nothing is shuffled."""
    at, out = docs.columns.index(text_col), docs
    for _, sent, rare in _with_rarity(docs, items, rules, text_col, item_id, item_text):

        def clean(batches: Iterator[pa.RecordBatch], sent=sent, rare=rare) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r[0] for r in block_leaks(sent.value, rare, batch.column(at).to_pylist(), rules)]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(clean, docs.schema)
    return out

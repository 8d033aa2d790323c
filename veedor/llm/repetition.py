"""Quality rules: repeated passages of a document, found in its suffix array.

Each document is read as a sequence of words. Documents are batched, the suffixes of a batch are
sorted by prefix doubling (a suffix never compares beyond its document) and the common prefixes of
neighbours come from the ranks of each doubling. A maximal run of suffixes whose common prefixes are
``length`` words or more is an interval; its prefix is a maximal repeat where the words before its
occurrences differ too, so that it can be extended on neither side. The spans of the maximal repeats
of at least ``min_repeat`` words are united; a document fails when they cover too large a part of it
or when one of them is too long. Repeats of two words already count here, so texts made of a few
phrases in changing order fail though they repeat no window of the base rule; and one long passage
that occurs twice fails a document of any length.

Memory is about 8 bytes for each word and doubling at which the word still starts a repeat: 100 bytes
a word in prose, up to 8 * log2(n) for n times the same word.

Null and empty texts have no words, fail the base rules and have no repeats. A document is never
compared with another, so repeated rows get equal results and ties cannot occur. Input columns other
than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"

#: Words per suffix array; documents are never split, so a longer one is an array of its own.
BATCH_WORDS = 16_384


@dataclass(frozen=True)
class RepetitionRules:
    min_words: int = 10  # fewer words fail
    window: int = 5  # words of a window of the base rule
    max_repeat_percent: int = 20  # of words in repeated windows
    min_repeat: int = 2  # words of a maximal repeat that counts
    max_covered: float = 0.2  # fraction of words in the united spans
    max_longest: int = 50  # words of the longest repeat


def suffix_array(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and for each the words it has in common with the one before it, none if that is another document's.

    words: non-negative integers; doc: the document of each position, ascending; end: for each
    position, where its document ends.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = doc.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    levels = []  # at each doubling, the positions whose ranks are still shared, and their ranks
    rank = np.empty(n, np.int32)
    ordered = key[order]
    new = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    size = np.diff(np.append(new, n))
    rank[order] = np.repeat(new, size)
    many = np.repeat(size > 1, size)
    active, slots = order[many], np.flatnonzero(many)
    h = 1
    while len(active):
        at = np.sort(active)
        levels.append((at.astype(np.int32), rank[at]))
        ahead = active + h
        inside = ahead < end[active]
        follow = np.where(inside, rank[np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
        key = rank[active].astype(np.int64) * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        order[slots] = active
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(starts, len(active)))
        rank[active] = np.repeat(slots[starts], size)
        many = np.repeat(size > 1, size)
        active, slots = active[many], slots[many]
        h *= 2
    common = np.zeros(n, np.int64)
    same = np.flatnonzero(doc[order[:-1]] == doc[order[1:]])
    a, b = order[same], order[same + 1]
    stop_a, stop_b = end[a], end[b]
    for k in range(len(levels) - 1, -1, -1):
        at, r = levels[k]
        x, y = (np.minimum(np.searchsorted(at, p), len(at) - 1) for p in (a, b))
        hit = (a < stop_a) & (b < stop_b) & (at[x] == a) & (at[y] == b) & (r[x] == r[y])
        step = hit.astype(np.int64) << k
        common[same + 1] += step
        a, b = a + step, b + step
    return order, common


def maximal_repeats(order: np.ndarray, common: np.ndarray, before: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The maximal repeats of ``least`` words or more: their intervals, as first and last place in ``order`` and words, and for each place the words of its innermost interval if that is maximal, else 0.

    before: the word before each position, another number for each document that begins there.
    """
    n = len(order)
    innermost = np.zeros(n, np.int64)
    deep = np.flatnonzero(common >= least)
    if not len(deep):
        return (*(np.zeros(0, np.int64) for _ in range(3)), innermost)
    prior = before[order]
    changes = np.concatenate(([0], np.cumsum(prior[1:] != prior[:-1])))
    gaps = np.flatnonzero(np.diff(deep) > 1)
    firsts, lasts, sizes = [], [], []
    for begin, stop in zip(deep[np.append(0, gaps + 1)].tolist(), deep[np.append(gaps, len(deep) - 1)].tolist(), strict=True):
        depth = [*common[begin : stop + 1].tolist(), 0]
        change = changes[begin - 1 : stop + 1].tolist()  # from the place before the run
        open_: list[tuple[int, int]] = []  # words and first place (from the one before the run) of open intervals
        for i, d in enumerate(depth):
            left = i
            while open_ and open_[-1][0] > d:
                words, left = open_.pop()
                if change[i] != change[left]:
                    firsts.append(begin - 1 + left)
                    lasts.append(begin - 1 + i)
                    sizes.append(words)
            if d >= least and (not open_ or open_[-1][0] < d):
                open_.append((d, left))
    first, last, words = (np.array(x, np.int64) for x in (firsts, lasts, sizes))
    # a place's innermost interval has the words of the deeper of its two borders: it is the one found that starts or ends there, or spans both
    inner = np.maximum(common, np.append(common[1:], 0))
    by = np.lexsort((first, words))
    key = words[by] * n + first[by]
    place = np.flatnonzero(inner >= least)
    at = np.searchsorted(key, inner[place] * n + place, "right") - 1
    hit = (at >= 0) & (words[by][np.maximum(at, 0)] == inner[place]) & (last[by][np.maximum(at, 0)] >= place) if len(by) else np.zeros(len(place), bool)
    innermost[place[hit]] = inner[place[hit]]
    return first, last, words, innermost


def _covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1)
    return np.cumsum(edge[:-1]) > 0


def analyse(texts: list[bytes | None], rules: RepetitionRules) -> dict[str, np.ndarray]:
    """The counts of each text."""
    m = len(texts)
    out = {
        k: np.zeros(m, np.int64)
        for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_maximal_repeats", "covered_words", "longest_repeat")
    }
    held: list[tuple[int, list[int]]] = []
    count, ids = 0, {}

    def flush() -> None:
        nonlocal count, ids
        if not held:
            return
        words = np.array([w for _, x in held for w in x], np.int64)
        sizes = np.array([len(x) for _, x in held])
        rows = np.array([i for i, _ in held])
        begin = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(held)), sizes)
        end = np.repeat(begin + sizes, sizes)
        n = len(words)
        order, common = suffix_array(words, doc, end)
        longest = np.empty(n, np.int64)
        longest[order] = np.maximum(common, np.append(common[1:], 0))
        hot = np.flatnonzero(longest >= rules.window)
        if len(hot):
            out["n_repeat_words"][rows] = np.add.reduceat(_covered(hot, hot + rules.window, n).astype(np.int64), begin)
        before = np.concatenate(([0], words[:-1]))
        before[begin] = -1 - np.arange(len(begin))
        first, _, _, inner = maximal_repeats(order, common, before, rules.min_repeat)
        if len(first):
            place = np.flatnonzero(inner)
            out["covered_words"][rows] = np.add.reduceat(_covered(order[place], order[place] + inner[place], n).astype(np.int64), begin)
            out["n_maximal_repeats"][rows] = np.bincount(doc[order[first]], minlength=len(held))
        out["longest_repeat"][rows] = np.maximum.reduceat(longest, begin)
        held.clear()
        count, ids = 0, {}

    for i, text in enumerate(texts):
        if not text:
            continue
        words = text.split()
        out["word_chars"][i] = len(text.translate(None, _SPACE + _CONTINUATION))
        out["n_symbols"][i] = len(text) - len(text.translate(None, _SYMBOLS))
        lines = [x for x in text.split(b"\n") if x.strip()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        out["n_words"][i] = len(words)
        if words:
            held.append((i, [ids.setdefault(w, len(ids)) for w in words]))
            count += len(words)
            if count >= BATCH_WORDS:
                flush()
    flush()
    return out


def quality_rules(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the counts, ``base_failed`` and ``kept``."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_maximal_repeats", "covered_words", "longest_repeat")
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = analyse(batch.column(1).to_pylist(), rules)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[k]) for k in names)], [id_col, *names])

    out = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("binary").alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, " + ", ".join(f"{k} long" for k in names)
    )
    n = F.col("n_words")
    base = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    bad = (F.col("covered_words") > rules.max_covered * n) | (F.col("longest_repeat") > rules.max_longest)
    return out.withColumn("base_failed", base).withColumn("kept", ~(base | bad))


def passes(found: dict[str, np.ndarray], rules: RepetitionRules) -> np.ndarray:
    """The verdict of ``quality_rules`` on the counts of ``analyse``."""
    n = found["n_words"]
    base = (n < rules.min_words) | (100 * found["n_repeat_words"] > rules.max_repeat_percent * n)
    return ~(base | (found["covered_words"] > rules.max_covered * n) | (found["longest_repeat"] > rules.max_longest))


def drop_low_quality(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that the rules reject, all columns as they are. Nothing is shuffled."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(passes(analyse(texts, rules), rules)))

    return docs.mapInArrow(run, docs.schema)

"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Texts become counts of hashed byte pairs and triples, of the bytes themselves and of their classes
(upper, lower, digit, sign, blank), of the lengths of words and lines, and of words and lines that
came before in the same text. Counts are damped by log(1 + n), weighted by inverse document frequency
and scaled to length one; the first ``dims`` right singular vectors of the labelled sample span the
latent space. The sample's latent vectors, at most ``max_labelled`` rows of ``dims`` floats, are
broadcast; each worker multiplies its documents by all of them, block by block, exactly. A document's
score is the mean label of its ``neighbours`` most similar labelled documents, weighted by
similarity to the power ``sharpness`` and so that labels in the proportions of the sample score ``threshold``.

The sample holds at most ``max_labelled`` labelled documents, those with the smallest hashes of their
ids, whatever the size of the corpus: a document's labels never reach its own score unless it is in
the sample, and rows of the held-out fold never are. Only texts enter the features.

Null and empty texts have a zero vector, similar to nothing: their score is 0.0 if the sample's empty
texts are mostly of label 0 or there are none, else 1.0. Null labels are ignored, of repeated ids in
the labels each row counts. Similarities are rounded to six places, beyond which the order of
additions shows; so repeated documents get equal scores, and ties between neighbours fall to the
earlier in the sample. A text of any length is read in pieces of about a megabyte; what is held of it
are two numbers for each word. Without any labelled row every score is 0.5. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

WIDTH = 2048
_KIND = np.full(256, 5, np.int64)  # non-ASCII bytes
_KIND[:128] = 4
_KIND[48:58] = 2
_KIND[65:91] = 1
_KIND[97:123] = 0
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_BLOCK = 512  # documents multiplied at once
_PIECE = 1 << 20  # bytes of a text read at once
_BLANKS = re.compile(rb"[ \t\n\x0b\x0c\r]")


@dataclass(frozen=True)
class VoteRules:
    max_labelled: int = 3000
    dims: int = 64
    neighbours: int = 25
    sharpness: float = 8.0
    threshold: float = 0.3


def features(text: bytes | None) -> np.ndarray:
    """Damped counts of the hashed features of a text."""
    out = np.zeros(WIDTH, np.float32)
    if not text:
        return out
    data = np.frombuffer(text, np.uint8)
    counts, kinds = np.zeros(WIDTH, np.int64), np.zeros(6, np.int64)
    for begin in range(0, len(data), _PIECE):
        b = data[begin : begin + _PIECE + 2].astype(np.int64)  # two more, for the pairs and triples that begin here
        m = min(_PIECE, len(b))
        kind = _KIND[b]
        sign = np.where(kind == 4, b, kind)  # signs keep their identity
        kinds += np.bincount(kind[:m], minlength=6)
        slots = [(b[:m] * 7 + 1) % 256]
        if len(b) > 1:
            slots += [(256 + (b[:-1] * 131 + b[1:] * 17) % 640)[:m], (896 + (sign[:-1] * 257 + sign[1:] * 31) % 256)[:m]]
        if len(b) > 2:
            slots += [(1152 + (sign[:-2] * 1009 + sign[1:-1] * 389 + sign[2:] * 97) % 512)[:m]]
        for s in slots:
            counts += np.bincount(s, minlength=WIDTH)
    sizes, words = (np.concatenate(x) for x in zip(*((np.fromiter(map(len, w), np.int64, len(w)), np.fromiter(map(hash, w), np.int64, len(w))) for w in _word_lists(text)), strict=True))
    lines = text.split(b"\n")
    counts += np.bincount(1664 + np.minimum(sizes if len(sizes) else [0], 31), minlength=WIDTH)
    counts += np.bincount(1696 + np.minimum(np.array([len(x) for x in lines]) // 16, 31), minlength=WIDTH)
    counts = counts.astype(np.float32)
    share = lambda part, whole: int(15 * part / whole) if whole else 0
    full = [x for x in lines if x.strip()]
    n = len(words)
    triples = words[:-2] * 3 + words[1:-1] * 5 + words[2:] * 7 if n > 2 else words[:0]
    marks = (
        (1728, share(n - len(np.unique(words)), n)),
        (1744, share(len(full) - len(set(full)), len(full))),
        (1760, min(15, n.bit_length())),
        (1776, share(int(kinds[1]), len(data))),
        (1792, share(int(kinds[4]), len(data))),
        (1824, share(int((words[1:] == words[:-1]).sum()), n - 1)),
        (1808, share(n - 2 - len(np.unique(triples)), n - 2) if n > 2 else 0),
    )
    for base, k in marks:
        counts[base + k] += 0.03 * len(data) + 2
    return np.log1p(counts, out=counts)


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, of about a megabyte at a time."""
    at = 0
    while at < len(text) or at == 0:
        cut = _BLANKS.search(text, at + _PIECE)
        stop = cut.start() if cut else len(text)
        yield text[at:stop].split()
        at = max(stop, 1)


@dataclass
class Votes:
    idf: np.ndarray
    axes: np.ndarray  # WIDTH x dims
    vectors: np.ndarray  # labelled x dims, length one
    labels: np.ndarray
    weights: np.ndarray
    empty: float
    rules: VoteRules

    @staticmethod
    def fit(x: np.ndarray, labels: np.ndarray, rules: VoteRules) -> Votes:
        """x: features, a row each."""
        blank = ~x.any(1)
        empty = 0.5 if not len(labels) else float(blank.any() and labels[blank].mean() > 0.5)
        x, labels = x[~blank], labels[~blank]
        if not len(labels):
            return Votes(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), labels, labels, empty, rules)
        idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
        x = x * idf
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
        axes = np.ascontiguousarray(axes[:, ::-1][:, : rules.dims], np.float32)
        ones = min(max(labels.mean(), 1 / (len(labels) + 1)), 1 - 1 / (len(labels) + 1))
        weights = np.where(labels > 0, rules.threshold / ones, (1 - rules.threshold) / (1 - ones)).astype(np.float32)
        v = x @ axes
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        return Votes(idf, axes, v, labels.astype(np.float32), weights, empty, rules)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.full(len(texts), self.empty)
        if not len(self.labels):
            return out
        k = min(self.rules.neighbours, len(self.labels))
        for begin in range(0, len(texts), _BLOCK):
            part = texts[begin : begin + _BLOCK]
            x = np.stack([features(t) for t in part])
            some = x.any(1)
            v = (x * self.idf) @ self.axes
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            like = np.round(v @ self.vectors.T, 6)
            least = np.partition(like, -k, axis=1)[:, -k, None]
            tied = like == least
            room = k - (like > least).sum(1, keepdims=True)
            near = np.nonzero((like > least) | (tied & (np.cumsum(tied, axis=1) <= room)))[1].reshape(len(part), k)
            w = np.maximum(np.take_along_axis(like, near, 1), 1e-6).astype(np.float64) ** self.rules.sharpness * self.weights[near]
            got = (w * self.labels[near]).sum(1) / w.sum(1)
            out[begin : begin + len(part)][some] = got[some]
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, rules: VoteRules = VoteRules(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5) -> Votes:
    """Learn from a bounded sample of the labelled documents outside the held-out fold."""
    small_batches(docs.sparkSession)
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label")).filter("id is not null and label is not null")
    known = known.filter(~held_out(F.col("id"), folds)).orderBy(F.xxhash64("id"), "id", "label").limit(rules.max_labelled)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    sample = texts.join(F.broadcast(known), "id")  # at most max_labelled rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).astype("<f2").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], ["id", "label", "x"])

    rows = sample.select("id", "label", "text").mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, label double, x binary").orderBy(F.xxhash64("id"), "id", "label").limit(rules.max_labelled).collect()
    x = np.stack([np.frombuffer(r["x"], "<f2").astype(np.float32) for r in rows]) if rows else np.zeros((0, WIDTH), np.float32)
    return Votes.fit(x, np.array([r["label"] for r in rows]), rules)


def held_out(id_: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, rules: VoteRules = VoteRules(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5) -> DataFrame:
    """One row per document: id, held_out, score and predicted."""
    votes = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rules, id_col, text_col, label_col, folds))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes.value.score(batch.column(1).to_pylist()))], [id_col, "score"])

    out = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("binary").alias("text")).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return out.select(id_col, held_out(F.col(f"`{id_col}`"), folds).alias("held_out"), "score", (F.col("score") >= rules.threshold).cast("int").alias("predicted"))

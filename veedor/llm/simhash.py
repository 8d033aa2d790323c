"""SimHash near-duplicates within a Hamming radius, by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 * half`` bits apart share a fingerprint at most ``half`` bits from
either. So every distinct fingerprint emits all its variants within ``half`` bits, the variants are
shuffled, and the fingerprints that meet at a variant are linked to the smallest of them, which is
verified by its distance. Copies collapse to one fingerprint before anything is emitted, and a
variant has no more visitors than a ball has members (65 for half 1), whatever the corpus holds, so
no group needs splitting. Any two visitors of one variant are within the radius of each other:
linking them to the smallest loses no connection.

Null and empty texts have fingerprint zero and are linked like any other. Rows that repeat an id
keep one row each. Ties do not matter: a component is named by its smallest id. Components without
any id (all null) have a null name. Input columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RID, discard, materialize, small_batches, stable_rows, tasks_for
from .components import connected_components


SPREAD = 16_384  # fingerprints whose balls one task emits


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64 bits, each 1 if it is set in over half of the hashes of the shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        line = b" ".join(words)
        stops = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *stops[:-shingle].tolist()]
        parts = [line[a:b] for a, b in zip(starts, (stops[shingle - 1 :] - 1).tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(p, seed) for p in parts], "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def signatures(docs: DataFrame, keep: list[str], text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed 64-bit integer."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            fps = np.array([fingerprint(t, shingle, seed) for t in batch.column(last).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(fps.view(np.int64))], [*keep, "fp"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    cols = [F.col(f"`{k}`") for k in keep]
    return docs.select(*cols, F.col(f"`{text_col}`").cast("binary")).mapInArrow(run, f"{kinds}, fp long")


def ball_links(fingerprints: DataFrame, half: int = 1) -> DataFrame:
    """Distinct links (a, b) between the distinct values of ``fp`` that are at most 2 * half bits apart; enough of them to connect all."""
    masks = [sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(64), k)]
    masks = [m - (1 << 64) if m >> 63 else m for m in masks]
    ball = F.explode(F.array(*(F.lit(m).cast("long") for m in masks)))
    fingerprints = materialize(fingerprints.select("fp").distinct(), "distinct")
    # 65 rows from each: dealt anew, as the few megabytes of fingerprints would be read by one or two tasks
    spread = fingerprints.repartition(tasks_for(fingerprints.count(), SPREAD), "fp")
    visits = spread.select("fp", ball.alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    # Nearly all variants have one visitor. The others go on, with the smallest visitor as their hub.
    met = visits.groupBy("variant").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = materialize(met, "variants")
    pairs = met.filter("n = 2").select("a", "b")
    # A visitor of a crowded variant is found again from the variant: its ball is the variant's ball.
    crowd = met.filter("n > 2").select("a", F.col("variant"), ball.alias("mask")).select("a", F.col("variant").bitwiseXOR(F.col("mask")).alias("b"))
    crowd = crowd.join(fingerprints.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return pairs.unionByName(crowd).filter((F.col("a") != F.col("b")) & (far <= 2 * half)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, half: int = 1) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` and ``component_id``, the smallest id that links reach."""
    sigs = materialize(signatures(docs, [id_col], text_col, shingle, seed), "fingerprints")
    return _with_components(sigs, id_col, half)


def _with_components(sigs: DataFrame, id_col: str, half: int) -> DataFrame:
    least = sigs.groupBy("fp").agg(F.min(id_col).alias("__least"))
    comp = connected_components(ball_links(sigs, half)).withColumnRenamed("node", "fp")
    named = least.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = materialize(named.groupBy("component").agg(F.min("__least").alias("component_id")), "names")  # a join with a plain table can split a hot component
    by_fp = named.select("fp", "component").join(names, "component").select("fp", "component_id", "component")
    return sigs.join(by_fp, "fp").withColumnRenamed("component", "__component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42, half: int = 1) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (nulls last), then the first row."""
    rows = stable_rows(docs)
    sigs = materialize(signatures(rows, [RID, id_col], text_col, shingle, seed), "fingerprints")
    comp = _with_components(sigs, id_col, half)
    first = F.min_by(F.col(RID), F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col(RID).alias("r")))
    kept = materialize(comp.groupBy("__component").agg(first.alias(RID)).select(RID), "kept")
    discard(sigs)
    return rows.join(kept, RID, "left_semi").drop(RID)

"""Token files: raw id payloads in document order, with a minimal perfect hash index over the keys.

Layout of a store (all under the shared folder):

* ``shard-NNNNNN.ids``: the ids of whole documents, each with its end id, as little-endian unsigned
  integers (two bytes where the vocabulary allows). Documents go by their ids, null ones last, or in
  the order of the rows; shards are cut where their texts reach a number of bytes, between rows that
  repeat an id too, so neither long texts nor a hot id make one shard larger.
* ``index-NNNNNN.mph``: for the keys of one hash bucket, the cascade of collision-free bit arrays
  (a key's slot is the number of set bits before the first level where its bit is set), then per
  slot a 32-bit fingerprint of the key, its shard, offset and length.

A key is (document id, occurrence): rows that repeat an id are counted from 0 in the order in which
they are stored (by id: by a hash of the text). A lookup reads one bit array after another, one slot, and compares the fingerprint; it costs
the same for any number of documents. Files are written under a temporary name and then renamed, so
a repeated task replaces a file by the same file.

Null and empty texts are a document of just the end id. An empty table gives a store without shards.
Input columns other than the id and the text are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import MOST_TASKS, RID, discard, file_system, materialize, scratch_path, small_batches, stable_rows, tasks_for
from .encoding import Encoder, shared_encoder, vocabulary_path

SHARD_BYTES = 128 << 20  # of text; more where there would be more than MOST_TASKS shards
SORTED_ROWS = 500_000  # rows that one task sorts to find where shards begin
BUCKET_KEYS = 1 << 17
GAMMA = 2.0  # bits per key of a level


def _put(root: str, name: str, write) -> None:
    """Create root/name through a temporary file. write gets an output stream."""
    fs, base = file_system(root)
    fs.create_dir(base, recursive=True)
    part = f"{base}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        write(out)
    fs.move(part, f"{base}/{name}")


# --- minimal perfect hashing -------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64((_STEP * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0..n-1 for n distinct keys, each a pair of 64-bit hashes."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # boolean arrays
        self.ranks = []
        before = 0
        for bits in levels:
            r = np.cumsum(bits, dtype=np.int64) + before
            self.ranks.append(r)
            before = int(r[-1])

    @staticmethod
    def build(a: np.ndarray, b: np.ndarray) -> PerfectHash:
        levels = []
        while len(a):
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
            size = max(8, int(GAMMA * len(a)))
            at = (_mix(a ^ _mix(b, len(levels)), len(levels)) % np.uint64(size)).astype(np.int64)
            hits = np.bincount(at, minlength=size)
            bits = hits == 1
            levels.append(bits)
            rest = ~bits[at]
            a, b = a[rest], b[rest]
        return PerfectHash(levels)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1 where no level knows the key."""
        out = np.full(len(a), -1, np.int64)
        open_ = np.arange(len(a))
        for k, bits in enumerate(self.levels):
            if not len(open_):
                break
            x, y = a[open_], b[open_]
            at = (_mix(x ^ _mix(y, k), k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.ranks[k][at[hit]] - 1
            open_ = open_[~hit]
        return out


_SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])


def _print_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (_mix(b ^ _mix(a, 991), 997) >> np.uint64(32)).astype(np.uint32)


def pack_index(a: np.ndarray, b: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray) -> bytes:
    mph = PerfectHash.build(a, b)
    table = np.zeros(len(a), _SLOT)
    at = mph.slots(a, b)
    for name, values in (("print", _print_of(a, b)), ("shard", shard), ("offset", offset), ("length", length)):
        table[name][at] = values
    head = json.dumps([len(x) for x in mph.levels]).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(np.packbits(x).tobytes() for x in mph.levels) + table.tobytes()


def open_index(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    at, levels = 4 + n, []
    for size in json.loads(data[4:at]):
        stop = at + (size + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(data[at:stop], np.uint8), count=size).astype(bool))
        at = stop
    return PerfectHash(levels), np.frombuffer(data[at:], _SLOT)


# --- the store ---------------------------------------------------------------------------------


@dataclass
class TokenStore:
    spark: SparkSession
    root: str
    dtype: str
    n_shards: int
    n_buckets: int
    id_col: str
    entries: DataFrame  # id, occurrence, shard, offset, length: what the index was made of


_ORDER = ["none", "rank", "tie", "q"]


def _ordered(docs: DataFrame, id_col: str, text_col: str, order: str) -> DataFrame:
    """key, text and the order of documents: ``none`` and ``rank``, ``tie``, and ``q`` to split rows that are equal in all."""
    key, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    if order == "id":
        docs = docs.select(key.alias("key"), text.alias("text"))
        none, rank = F.col("key").isNull(), F.coalesce("key", F.lit(0))
    else:
        docs = stable_rows(docs).select(key.alias("key"), text.alias("text"), F.col(RID).alias("rank"))
        none, rank = F.lit(False), F.col("rank")
    return docs.select("key", "text", none.alias("none"), rank.alias("rank"), F.xxhash64("text").alias("tie"), F.rand(7).alias("q"))


def _cuts(docs: DataFrame, shard_bytes: int) -> list[tuple]:
    """Where all shards but the first begin, in terms of the order; their number follows the bytes of the texts."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64
    light = docs.select(*_ORDER, size.alias("size"))
    total, n = light.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 0
    shards = min(MOST_TASKS, max(1, -(-total // shard_bytes), min(docs.sparkSession.sparkContext.defaultParallelism, n // 1000)))
    if shards == 1:
        return []
    light = materialize(light.repartitionByRange(tasks_for(n, SORTED_ROWS), *_ORDER).withColumn("range", F.spark_partition_id()), "sizes")
    totals = sorted(light.groupBy("range").agg(F.sum("size").alias("n")).collect())  # no more rows than tasks
    ahead, upto = {}, 0
    for k, m in totals:
        ahead[k], upto = upto, upto + m
    base = F.element_at(F.create_map(*(F.lit(x).cast("long") for kv in ahead.items() for x in kv)), F.col("range").cast("long"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("range").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shard = F.floor((base + before) / F.lit(total / shards))
    first = light.withColumn("shard", shard).groupBy("shard").agg(F.min(F.struct(*_ORDER)).alias("at")).collect()  # no more rows than shards
    discard(light)
    return sorted(tuple(r["at"]) for r in first)[1:]


def write_payload(docs: DataFrame, root: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, plain_specials: bool = False, order: str = "id") -> tuple[DataFrame, int, str]:
    """Write the shards. Returns (key, occurrence, shard, offset, length) of every document, the number of shards and the type of an id."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = _ordered(docs, id_col, text_col, order)
    cuts = _cuts(docs, shard_bytes)
    n_shards = len(cuts) + 1
    dtype = Encoder(tokenizer).dtype
    width = dtype.itemsize

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, plain_specials)
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = [bisect_right(cuts, x) for x in zip(*(batch.column(c).to_pylist() for c in _ORDER), strict=True)] if cuts else np.zeros(len(batch), np.int64)
            z = [press.compress(x) for x in encoder.encode(batch.column("text").to_pylist(), end_id)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(batch.column(c) for c in ("none", "rank", "tie", "key")), pa.array(z, pa.binary())], ["shard", "none", "rank", "tie", "key", "z"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        fs, base = file_system(root)
        fs.create_dir(base, recursive=True)
        shard, out, part, offset = None, None, "", 0

        def close():
            if out is not None:
                out.close()
                fs.move(part, f"{base}/shard-{shard:06d}.ids")

        for batch in batches:
            offsets, lengths = [], []
            for s, z in zip(batch.column("shard").to_pylist(), batch.column("z").to_pylist(), strict=True):
                if s != shard:
                    close()
                    shard, offset, part = s, 0, f"{base}/.shard-{s:06d}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(part)
                data = unpress.decompress(z)
                out.write(data)
                offsets.append(offset)
                lengths.append(len(data) // width)
                offset += lengths[-1]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("shard"), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["key", "shard", "offset", "length"])
        close()

    coded = docs.select("key", F.col("text").cast("binary").alias("text"), *_ORDER).mapInArrow(encode, "shard int, none boolean, rank long, tie long, key long, z binary")
    dealt = coded.repartitionById(n_shards, "shard").sortWithinPartitions("shard", "none", "rank", "tie", "z")
    entries = materialize(dealt.mapInArrow(write, "key long, shard int, offset long, length long"), "written")
    # occurrences in two levels, within a shard and then over the shards of a key, so that a hot key is counted in many tasks
    here = entries.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    several = materialize(here.withColumn("ahead", ahead).filter("n > 1 or ahead > 0").select("key", F.col("shard"), "ahead"), "repeats")
    same = entries["key"].eqNullSafe(several["key"]) & (entries["shard"] == several["shard"])
    known = entries.join(several, same, "left").select(entries["key"], entries["shard"], "offset", "length", "ahead")
    rank = F.row_number().over(Window.partitionBy("key", "shard").orderBy("offset")) - 1
    counted = known.filter("ahead is not null").withColumn("occurrence", F.col("ahead") + rank).unionByName(known.filter("ahead is null").withColumn("occurrence", F.lit(0).cast("long")))
    return materialize(counted.select("key", "occurrence", "shard", "offset", "length"), "entries"), n_shards, dtype.str


def _hashed(keys: DataFrame, n_buckets: int) -> DataFrame:
    a, b = F.xxhash64("key", "occurrence"), F.xxhash64(F.lit("veedor"), "occurrence", "key")
    return keys.select("*", a.alias("a"), b.alias("b"), F.pmod(a.bitwiseXOR(b), F.lit(n_buckets)).cast("int").alias("bucket"))


def write_store(docs: DataFrame, root: str | None = None, tokenizer: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, order: str = "id") -> TokenStore:
    """Encode, write and index every document, ordered by id or, with order="rows", as the rows are: by the number of their file, then their place in it."""
    spark = docs.sparkSession
    root = root or scratch_path(spark, "tokens")
    entries, n_shards, dtype = write_payload(docs, root, tokenizer or vocabulary_path(), end_id, id_col, text_col, shard_bytes, order=order)
    n_buckets = max(1, -(-entries.count() // BUCKET_KEYS))

    def index(table: pa.Table) -> pa.Table:
        a, b = (np.asarray(table[c]).view(np.uint64) for c in "ab")
        data = pack_index(a, b, *(np.asarray(table[c]) for c in ("shard", "offset", "length")))
        k = table["bucket"][0].as_py()
        _put(root, f"index-{k:06d}.mph", lambda out: out.write(data))
        return pa.table({"bucket": pa.array([k], pa.int32()), "n": pa.array([table.num_rows], pa.int64()), "bytes": pa.array([len(data)], pa.int64())})

    done = _hashed(entries, n_buckets).groupBy("bucket").applyInArrow(index, "bucket int, n long, bytes long")
    keys = done.agg(F.sum("n")).first()[0] or 0
    about = {"dtype": dtype, "end_id": end_id, "shards": n_shards, "buckets": n_buckets, "documents": keys}
    _put(root, "store.json", lambda out: out.write(json.dumps(about).encode()))
    return TokenStore(spark, root, dtype, n_shards, n_buckets, id_col, entries)


def lookup(store: TokenStore, keys: DataFrame) -> DataFrame:
    """(key, occurrence, shard, offset, length) of the keys that the index knows. keys: columns key and occurrence."""
    root = store.root

    def find(table: pa.Table) -> pa.Table:
        fs, base = file_system(root)
        name = f"{base}/index-{table['bucket'][0].as_py():06d}.mph"
        if fs.get_file_info(name).type == pafs.FileType.NotFound:
            table = table.slice(0, 0)
            mph, slots = PerfectHash([]), np.zeros(0, _SLOT)
        else:
            with fs.open_input_file(name) as f:
                mph, slots = open_index(f.read())
        a, b = (np.asarray(table[c]).view(np.uint64) for c in "ab")
        at = mph.slots(a, b)
        known = at >= 0
        known[known] = slots["print"][at[known]] == _print_of(a, b)[known]
        row = slots[at[known]]
        table = table.filter(pa.array(known))
        return pa.table({"key": table["key"], "occurrence": table["occurrence"], "shard": pa.array(row["shard"].astype(np.int32)), "offset": pa.array(row["offset"].astype(np.int64)), "length": pa.array(row["length"].astype(np.int64))})

    return _hashed(keys.select("key", "occurrence"), store.n_buckets).groupBy("bucket").applyInArrow(find, "key long, occurrence long, shard int, offset long, length long")


def read_back(store: TokenStore, found: DataFrame) -> DataFrame:
    """(key, occurrence, shard, offset, n_tokens, ids_crc32) from the payloads that ``found``, a lookup, points to."""
    root, dtype = store.root, np.dtype(store.dtype)

    def read(table: pa.Table) -> pa.Table:
        fs, base = file_system(root)
        table = table.sort_by("offset")
        crc = []
        with fs.open_input_file(f"{base}/shard-{table['shard'][0].as_py():06d}.ids") as f:
            for at, n in zip(table["offset"].to_pylist(), table["length"].to_pylist(), strict=True):
                ids = np.frombuffer(f.read_at(n * dtype.itemsize, at * dtype.itemsize), dtype)
                crc.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        n, c = zip(*crc, strict=True)
        return pa.table({"key": table["key"], "occurrence": table["occurrence"], "shard": table["shard"], "offset": table["offset"], "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(c, pa.int64())})

    return found.groupBy("shard").applyInArrow(read, "key long, occurrence long, shard int, offset long, n_tokens long, ids_crc32 long")


def documents_of(store: TokenStore) -> DataFrame:
    """One row per document, looked up by key and read from its shard: id, start, n_tokens, ids_crc32, occurrence, shard."""
    rows = read_back(store, lookup(store, store.entries))
    totals = store.entries.groupBy("shard").agg(F.sum("length").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    base = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(base, "shard").select(
        F.col("key").alias(store.id_col), (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "occurrence", "shard"
    )

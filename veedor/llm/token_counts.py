"""Token counts of flat token files: a scan for end-of-document ids, block by block.

The files are nothing but ids; no index says where documents begin. Every file is cut into blocks of
``block_bytes``; a task searches the end id in a whole block at once and reports the places. A prefix
scan over the blocks of a file (one short row a block) carries the number of documents before a block
and the last end before it, which stitches documents that cross borders, however many blocks long.

Documents are told by file and by their ordinal in it. Ids after the last end id of a file are a
document that is not ``ended``; a file without ids has no documents. A file whose size isn't a
multiple of the id width is an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import file_system, materialize, scratch_path, small_batches, tasks_for
from .encoding import Encoder, shared_encoder, vocabulary_path

BLOCK_BYTES = 8 << 20


def list_files(root: str, suffix: str = ".ids") -> list[tuple[str, int]]:
    fs, base = file_system(root)
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    return sorted((f.base_name, f.size) for f in found if f.is_file and f.base_name.endswith(suffix))


def count_tokens(spark: SparkSession, root: str, end_id: int, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES, suffix: str = ".ids") -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document in the files of ``root``; n_tokens counts the end id."""
    small_batches(spark)
    width = np.dtype(dtype).itemsize
    files = list_files(root, suffix)
    if odd := [name for name, size in files if size % width]:
        raise ValueError(f"not whole ids: {odd[:3]}")
    block_ids = max(1, block_bytes // width)
    table = spark.createDataFrame([(name, size // width) for name, size in files if size], "file string, ids long")
    blocks = table.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("ids") - 1) / F.lit(block_ids)))).alias("block"))
    blocks = blocks.repartition(tasks_for(sum(-(-size // block_bytes) for _, size in files) - 1, 1), "file", "block")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        for batch in batches:
            for name, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin = block * block_ids
                with fs.open_input_file(f"{base}/{name}") as f:
                    data = f.read_at(block_ids * width, begin * width)
                ends = np.flatnonzero(np.frombuffer(data, dtype) == end_id) + begin
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([block], pa.int64()), pa.array([begin + len(data) // width], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], ["file", "block", "upto", "ends"]
                )

    found = materialize(blocks.select("file", "block").mapInArrow(scan, "file string, block long, upto long, ends array<long>"), "ends")
    summary = found.select("file", "block", "upto", F.size("ends").cast("long").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    each = found.join(carry, ["file", "block"]).select("file", "before", "carried", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.coalesce(F.when(F.col("k") > 0, F.get("ends", F.col("k") - 1)).otherwise(F.col("carried")) + 1, F.lit(0))
    whole = each.select("file", (F.col("before") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("end") + 1 - start).alias("n_tokens"), F.lit(True).alias("ended"))
    totals = summary.groupBy("file").agg(F.sum("n").alias("ordinal"), F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"), F.max("upto").alias("upto"))
    rest = totals.filter("upto > start").select("file", "ordinal", "start", (F.col("upto") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return whole.unionByName(rest)


def write_flat(docs: DataFrame, root: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Encode documents into flat files, one for each task. Returns (id, file, ordinal) of every document as written, and the type of an id.

    Where a document went is told by the task that wrote it, so nothing depends on how rows are split
    among tasks another time.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, True)
        fs, base = file_system(root)
        fs.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}.ids"
        part = f"{base}/.{name}-{uuid.uuid4().hex}"
        out, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or fs.open_output_stream(part)
            for ids in encoder.encode(batch.column(1).to_pylist(), end_id):
                out.write(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * batch.num_rows), pa.array(np.arange(n, n + batch.num_rows))], ["id", "file", "ordinal"])
            n += batch.num_rows
        if out is not None:
            out.close()
            fs.move(part, f"{base}/{name}")

    places = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary")).mapInArrow(write, f"id {kind}, file string, ordinal long")
    return materialize(places, "places"), Encoder(tokenizer).dtype.str


def document_counts(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write ``docs`` to flat files, scan the files and give each id its count: id, n_tokens, file, ordinal.

    Nothing is shuffled to write the files. The end id is the vocabulary's <|endoftext|> unless another
    is given; texts never hold it, as special tokens in them are encoded as ordinary text. Null and
    empty texts are one id long. A scan that finds more or fewer documents than were written is an
    error.
    """
    spark = docs.sparkSession
    path = tokenizer or vocabulary_path()
    if end_id is None:
        end_id = Tokenizer.from_file(path).token_to_id("<|endoftext|>")
    root = scratch_path(spark, "flat")
    places, dtype = write_flat(docs, root, path, end_id, id_col, text_col)
    counts = materialize(count_tokens(spark, root, end_id, dtype, block_bytes), "counts")
    if (found := counts.count()) != (written := places.count()):
        raise RuntimeError(f"the files of {root} hold {found} documents, {written} were written")
    return places.join(counts, ["file", "ordinal"]).select(F.col("id").alias(id_col), "n_tokens", "file", "ordinal")

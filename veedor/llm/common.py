"""Shared plumbing of the corpus operators: scratch tables, stable row ids, text columns.

Scratch tables are written to the folder that ``spark.checkpoint.dir`` names, so that a lost
executor never takes an intermediate result with it, and cut the lineage of iterative plans.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``[^\x20\x09-\x0D]+`` as Java and DuckDB both read it.
WORD = r"[^\x20\x09-\x0D]+"
#: Row id used inside operators; no input column may use it.
RID = "__veedor_rid"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_PART = r"^part-(\d{1,9})"
_WRITTEN: list[str] = []
MOST_TASKS = 20_000  # of one stage: beyond it tasks grow, not their number


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster. A local session without one gets a temporary folder; a cluster without one is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        path = "file://" + tempfile.mkdtemp(prefix="veedor-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/veedor-{tag}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path behind the uri of a shared folder, for files that tasks write themselves."""
    scheme, rest = uri.split("://", 1) if "://" in uri else ("", uri)
    scheme = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}.get(scheme, scheme)
    return pafs.FileSystem.from_uri(f"{scheme}://{rest}") if scheme else pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") else f"file://{uri}")


def tasks_for(n: int, each: int) -> int:
    """How many tasks share n units: about ``each`` to a task, more where that would be too many tasks."""
    return int(max(1, min(n // each + 1, MOST_TASKS)))


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its shuffle files go when it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._veedor_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_veedor_path", None):
            _delete(df.sparkSession, path)


def discard_all(spark: SparkSession) -> None:
    """Delete all scratch tables and files that this process has written: for the end of a job, when its results are stored."""
    for path in list(_WRITTEN):
        _delete(spark, path)


def stable_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``RID``, a number for each row that every job sees the same, in the order of files and rows.

    It is made of the number of the row's file and the row's place in it, so it doesn't follow the way
    files are split among tasks. Anything but the plain scan of a table in Parquet files that are told
    by their part numbers is written first.
    """
    parts = _parts(docs)
    if parts is None:
        docs = materialize(docs, "rows")
    number = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract("_metadata.file_name", _PART, 1), F.lit("")), F.lit("9" * 9)).cast("long"), F.lit(0))
    out = docs.select("*", (F.shiftleft(number.cast("long"), 36) + F.col("_metadata.row_index")).alias(RID))
    out._veedor_path = getattr(docs, "_veedor_path", None) if parts is None else None
    return out


def _parts(docs: DataFrame) -> list[int] | None:
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return None
    files = docs.inputFiles()
    found = [re.search(_PART, f.rsplit("/", 1)[-1]) for f in files]
    if not files or not all(f.endswith(".parquet") for f in files) or (len(files) > 1 and not all(found)):
        return None
    numbers = [int(m[1]) if m else 0 for m in found]
    return numbers if len(set(numbers)) == len(numbers) else None


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 where it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once: 1,000 rows and about 16 MB a batch, for the whole session.

    Workers that share this machine's files also find this package, wherever the driver was started.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16777216")
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])

"""Reading the source tables: dialects, validation, bad rows, row order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions.money import clean_currency
from .specs import SPECS, TableSpec

_BAD = "_corrupt"


def read_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """The names in the first line; no other line is parsed."""
    return spark.read.option("header", True).option("encoding", encoding).option("inferSchema", False).csv(path).columns


def resolve_dialect(spec: TableSpec, header: Iterable[str]) -> dict[str, str]:
    """Column to its name in the file: all portal names if all are there, else the API name of each that lacks."""
    found = set(header)
    if found.issuperset(spec.columns):
        return {c: c for c in spec.columns}
    return {c: c if c in found else spec.api_name(c) for c in spec.columns}


def validate_header(expected: Iterable[str], header: Iterable[str], path: str = "") -> None:
    """ValueError that names the expected columns the file lacks."""
    lacking = sorted(set(expected) - set(header))
    if lacking:
        raise ValueError(f"{path} lacks columns: {', '.join(lacking)}")


def _csv(spark: SparkSession, path: str, columns: list[str], header: bool, encoding: str) -> DataFrame:
    spec = TableSpec("", "", "", tuple(columns)).schema().add(_BAD, "string")
    read = spark.read.schema(spec).option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
    return read.option("multiLine", False).option("quote", '"').option("escape", '"').option("enforceSchema", True).option("columnPruning", False).csv(path)  # all fields, or bad rows go unseen


def read_raw(spark: SparkSession, spec: TableSpec, path: str, encoding: str = "UTF-8", validate: bool = True) -> DataFrame:
    """All rows with the declared columns as text, ``_corrupt`` (the line of a bad row) and ``ord``.

    ord follows files by name and rows by place; it is the order that first and last winners mean.
    """
    if spec.has_header:
        header = read_header(spark, path, encoding)
        names = resolve_dialect(spec, header)
        if validate:
            validate_header(names.values(), header, path)
        df = _csv(spark, path, header, True, encoding)
        cols = [F.col(f"`{names[c]}`").alias(c) for c in spec.columns if names[c] in header]
    else:
        df = _csv(spark, path, [f"_c{i}" for i in range(spec.width)], False, encoding)
        cols = [F.col(f"_c{i}").alias(c) for i, c in zip(spec.positions, spec.columns, strict=True)]
    # Spark answers nothing that reads only the corrupt-record column; this one needs a second column
    bad = F.when(F.col(_BAD).isNotNull() | (F.coalesce(cols[0], F.lit("")) == "\0"), F.col(_BAD)).alias(_BAD)
    return df.select(*cols, bad, F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")).alias("ord"))


def read_table(spark: SparkSession, name: str, config: EngineConfig = EngineConfig(), path: str | None = None, columns: Iterable[str] | None = None) -> DataFrame:
    """Good rows of a table, money as numbers, with ``ord``. columns: those to keep, for pruning at the scan."""
    spec = SPECS[name]
    df = read_raw(spark, spec, path or config.path(spec.folder, spec.file), config.encoding).filter(F.col(_BAD).isNull())
    wanted = list(columns) if columns is not None else list(spec.columns)
    return df.select(*(clean_currency(F.col(f"`{c}`")).alias(c) if c in spec.currency else F.col(f"`{c}`") for c in wanted), "ord")


def bad_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))


def validate_folder(spark: SparkSession, config: EngineConfig, names: Iterable[str]) -> dict[str, str]:
    """Table to "ok" or what is wrong with its header."""
    out = {}
    for name in names:
        spec = SPECS[name]
        path = config.path(spec.folder, spec.file)
        try:
            header = read_header(spark, path, config.encoding)
            validate_header(resolve_dialect(spec, header).values() if spec.has_header else (), header, path)
            out[name] = "ok"
        except Exception as e:  # the report says which file and why
            out[name] = str(e).splitlines()[0]
    return out


def header_inventory(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(path, position, column) of some CSV files."""
    rows = [(p, i, c) for p in paths for i, c in enumerate(read_header(spark, p))]
    return spark.createDataFrame(rows, "path string, position int, column string")


def union_pages(pages: Iterable[DataFrame]) -> DataFrame:
    """Pages of one table, whatever the order of their columns."""
    out = None
    for p in pages:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out

"""Artifacts: tables that are built once, and small JSON and CSV outputs."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class ArtifactStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        """Whether a complete table is there: its writer has committed it."""
        p, fs = self._fs(self.path(name) + "/_SUCCESS")
        return fs.exists(p)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name)

    def get_or_build(self, name: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
        return self.read(name) if not force and self.exists(name) else self.write(name, build())

    def write_csv(self, name: str, df: DataFrame) -> str:
        """A folder of files with headers."""
        df.write.mode("overwrite").option("header", True).csv(self.path(name))
        return self.path(name)

    def write_json(self, name: str, value: object) -> str:
        p, fs = self._fs(self.path(name))
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(value, ensure_ascii=False, sort_keys=True, indent=1).encode()))
        out.close()
        return self.path(name)

    def read_json(self, name: str) -> object:
        return json.loads("\n".join(r[0] for r in self.spark.read.text(self.path(name)).collect()))

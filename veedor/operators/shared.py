"""Tables that a plan reads several times, written once to the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written and cut from its lineage. The folder is the session's own, else spark.checkpoint.dir; only a local session may do without."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="veedor-"))
    return df.checkpoint()

"""Contracts as a stream: rule flags and scores against static history, thresholds and processes.

A provider's history needs all its past, so it stays a batch table; arriving contracts are probed
against it batch by batch, which costs one pass over the history of a batch's providers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import RuleSet
from ..operators import flags, history, thresholds


def score_batch(batch: DataFrame, past: DataFrame, limits: DataFrame, rules: RuleSet = RuleSet()) -> DataFrame:
    """Flags and scores of some typed contracts.

    batch: what ``flags.rule_flags`` needs but history and thresholds, with tipo_norm, num_norm and
    dia. past: tipo_norm, num_norm, dia, m1 and m2 of known contracts.
    """
    keys = ["tipo_norm", "num_norm"]
    mine = past.join(batch.select(*keys).distinct(), keys, "left_semi")
    out = history.probe_history(batch, mine, keys, "dia", {"num_sobrecostos_previos": "m1", "num_retrasos_previos": "m2"}, "num_contratos_previos_nacional")
    out = thresholds.attach_thresholds(out, limits, "tipo_contrato", flags.WANTED, rules.default_thresholds)
    return flags.rule_scores(flags.rule_flags(out, rules))


def score_stream(stream: DataFrame, past: DataFrame, limits: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, rules: RuleSet = RuleSet(), once: bool = False) -> StreamingQuery:
    """Runs ``score_batch`` on every micro-batch and hands the result to the sink, with the batch's number for idempotent writes."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, i: sink(score_batch(df, past, limits, rules), i))
    return (writer.trigger(availableNow=True) if once else writer).start()


def award_counts(stream: DataFrame, time_col: str, window: str = "1 day", delay: str = "7 days") -> DataFrame:
    """Contracts and value by window and modality; rows later than ``delay`` are dropped by the watermark."""
    return stream.withWatermark(time_col, delay).groupBy(F.window(time_col, window), "modalidad").agg(F.count(F.lit(1)).alias("n"), F.sum("valor_contrato").alias("valor"))

"""The composite score, its bands, and documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import RISK_BANDS, SCORE_WEIGHTS


def composite_score(inputs: Mapping[str, Column], weights: Mapping[str, float] = SCORE_WEIGHTS) -> Column:
    """The weighted sum, a missing input as 0, rounded half to even at 6 places."""
    total = F.lit(0.0)
    for name, w in weights.items():
        total = total + F.coalesce(inputs[name].cast("double"), F.lit(0.0)) * w
    return F.bround(total, 6)


def risk_band(score: Column, bands=RISK_BANDS) -> Column:
    """The band with low <= score < high; the last includes its end; null outside."""
    out = F.when((score >= bands[-1][1]) & (score <= bands[-1][2]), bands[-1][0])
    for name, low, high in reversed(bands[:-1]):
        out = F.when((score >= low) & (score < high), name).otherwise(out)
    return out


def direction(attribution: Column) -> Column:
    return F.when(attribution > 0, "risk_increasing").otherwise("risk_reducing")


def document(**fields: Column) -> Column:
    """A JSON document with its fields by name; numbers have 6 places, nulls stay."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})

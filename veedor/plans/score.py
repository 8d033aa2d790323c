"""Scoring: model probabilities, rule score, composite score, band and a JSON document per contract.

One code path for a table and for a single contract, which is a table of one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RuleSet
from ..functions.scoring import composite_score, document, risk_band
from ..models.attribution import explain
from ..models.training import Trained

#: The composite score's inputs by model.
INPUTS = {"M1": "m1_cost_overruns", "M2": "m2_delays", "M3": "m3_comptroller", "M4": "m4_fines"}


def score_contracts(matrix: DataFrame, models: Mapping[str, Trained], rules: RuleSet = RuleSet(), id_col: str = "id_contrato") -> DataFrame:
    """The matrix with a probability of each model, ``cri`` and ``risk_level``; a missing model or score counts as 0."""
    out = matrix
    for name, model in models.items():
        out = model.score(out, INPUTS[name])
    for name in INPUTS.values():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast("double"))
    inputs = {n: F.col(n) for n in INPUTS.values()} | {"iric": F.col("iric_score")}
    out = out.withColumn("cri", composite_score(inputs, rules.score_weights))
    return out.withColumn("risk_level", risk_band(F.col("cri"), rules.risk_bands))


def documents(scored: DataFrame, models: Mapping[str, Trained], features: Sequence[str], id_col: str = "id_contrato", top: int = 10) -> DataFrame:
    """(id, document): scores, band, features and each model's strongest attributions, fields in sorted order."""
    out = scored
    for name, model in models.items():
        each = explain(model.model, scored, id_col, model.features, top)
        entry = F.struct("rank", "direction", "feature", "original_value", "shap_value")
        shap = each.groupBy(id_col).agg(F.array_sort(F.collect_list(entry)).alias(f"shap_{name}"))  # top entries a row
        out = out.join(shap, id_col, "left")
    raw = F.struct(*(F.round(F.col(f).cast("double"), 6).alias(f) for f in sorted(features)))
    parts = {name: F.struct(F.round(INPUTS[name], 6).alias("probability"), F.col(f"shap_{name}").alias("shap")) for name in models}
    fields = {"cri": F.struct(F.col("cri").alias("score"), F.col("risk_level").alias("level")), "raw_features": raw, "contract": F.col(id_col).cast("string"), "iric": F.round("iric_score", 6)}
    if parts:
        fields["models"] = F.struct(*(v.alias(k) for k, v in sorted(parts.items())))
    return out.select(id_col, document(**fields).alias("document"))

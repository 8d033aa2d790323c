"""Boosted trees: class weights or upsampling, seeded search over folds, final fit."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ranking
from .split import folds, stratified_split, upsample

MISSING = -1.0

#: Where the search draws from: name to values or to (low, high).
SPACE: Mapping[str, Sequence] = {
    "maxIter": (20, 40, 60, 100),
    "maxDepth": (3, 4, 5, 6, 7),
    "stepSize": (0.02, 0.05, 0.1, 0.2),
    "subsamplingRate": (0.6, 0.8, 1.0),
    "minInstancesPerNode": (1, 5, 10, 20),
    "minInfoGain": (0.0, 0.0001, 0.001),
    "featureSubsetStrategy": ("all", "sqrt", "onethird"),
}


@dataclass(frozen=True)
class TrainConfig:
    candidates: tuple[dict, ...] | None = None  # instead of drawing
    n_candidates: int = 20
    folds: int = 5
    share: float = 0.7
    seed: int = 42


def draw(n: int, seed: int = 42, space: Mapping[str, Sequence] = SPACE) -> tuple[dict, ...]:
    rng = random.Random(seed)
    return tuple({k: rng.choice(v) for k, v in space.items()} for _ in range(n))


def vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """df with ``features``: each value, or MISSING, and whether it is missing (trees take no NaN)."""
    filled = df.withColumns({f"__v_{f}": F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), F.lit(MISSING)) for f in features} | {f"__m_{f}": F.col(f).isNull().cast("double") for f in features})
    return VectorAssembler(inputCols=[f"__v_{f}" for f in features] + [f"__m_{f}" for f in features], outputCol="features").transform(filled).drop(*(f"__{p}_{f}" for f in features for p in "vm"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """df with ``weight``: negatives per positive on positives, 1 on negatives."""
    pos, n = df.agg(F.sum(label), F.count(F.lit(1))).first()
    ratio = (n - pos) / pos if pos else 1.0
    return df.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(1.0))


def fit_model(df: DataFrame, label: str, features: Sequence[str], params: Mapping, strategy: str = "weights", seed: int = 42, id_col: str = "id") -> GBTClassificationModel:
    data = class_weights(df, label) if strategy == "weights" else upsample(df, label, id_col=id_col, seed=seed).withColumn("weight", F.lit(1.0))
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=seed, **params)
    return gbt.fit(vectors(data, features).select("features", F.col(label).cast("double").alias(label), "weight"))


def predict(model: GBTClassificationModel, df: DataFrame, features: Sequence[str], to: str = "score") -> DataFrame:
    out = model.transform(vectors(df, features))
    return out.withColumn(to, F.round(vector_to_array("probability")[1], 6)).drop("features", "rawPrediction", "probability", "prediction")


@dataclass
class Trained:
    model: GBTClassificationModel
    features: list[str]
    strategy: str
    params: dict
    cv_auc: float
    test: DataFrame
    trials: list[dict] = field(default_factory=list)

    def score(self, df: DataFrame, to: str = "score") -> DataFrame:
        return predict(self.model, df, self.features, to)

    def report(self) -> dict:
        return {"strategy": self.strategy, "params": self.params, "cv_auc": self.cv_auc, "features": self.features, "trials": self.trials}


def train(df: DataFrame, id_col: str, label: str, features: Sequence[str], config: TrainConfig = TrainConfig()) -> Trained:
    """Stratified split, search over candidates and both strategies by mean fold AUC (ties: weights first), final fit on the training part."""
    known = df.filter(F.col(label).isNotNull())
    parts = stratified_split(known, label, config.share, id_col=id_col, seed=config.seed)
    # read by every fold and candidate; what a lost executor held is computed again from its source
    fit_part = folds(parts.filter("train"), label, config.folds, id_col, config.seed).drop("train").persist()
    pos = fit_part.agg(F.sum(label)).first()[0] or 0
    k = max(2, min(config.folds, int(pos)))
    candidates = config.candidates or draw(config.n_candidates, config.seed)
    trials = []
    for strategy in ("weights", "upsample"):
        for params in candidates:
            scores = []
            for i in range(k):
                model = fit_model(fit_part.filter(F.pmod("fold", F.lit(k)) != i), label, features, params, strategy, config.seed, id_col)
                got = ranking.auc(predict(model, fit_part.filter(F.pmod("fold", F.lit(k)) == i), features), "score", label).first()[0]
                scores.append(0.5 if got is None else got)
            trials.append({"strategy": strategy, "params": dict(params), "auc": sum(scores) / len(scores)})
    best = max(trials, key=lambda t: t["auc"])  # the first of equals
    model = fit_model(fit_part, label, features, best["params"], best["strategy"], config.seed, id_col)
    fit_part.unpersist()
    return Trained(model, list(features), best["strategy"], best["params"], best["auc"], parts.filter("not train").drop("train"), trials)


def evaluate(scored: DataFrame, score: str, label: str, id_col: str) -> dict[str, DataFrame]:
    """All metric tables of a scored table."""
    return {
        "auc": ranking.auc(scored, score, label),
        "average_precision": ranking.average_precision(scored, score, label),
        "map": ranking.mean_average_precision(scored, score, label, id_col),
        "recall_precision": ranking.recall_precision(scored, score, label, id_col),
        "ndcg": ranking.ndcg(scored, score, label, id_col),
        "thresholds": ranking.threshold_sweep(scored, score, label),
        "calibration": ranking.calibration(scored, score, label),
        "histogram": ranking.score_histogram(scored, score, label),
        "reliability": ranking.reliability(scored, score, label),
        "roc": ranking.roc_curve(scored, score, label),
        "pr": ranking.pr_curve(scored, score, label),
    }

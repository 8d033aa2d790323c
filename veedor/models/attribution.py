"""Path-dependent Shapley values of boosted trees, exact, in Arrow batches.

The value of a set of features is the tree's mean over the paths that agree with it, by training
cover. For each leaf only the features on its path matter: with at most ``maxDepth`` of them, the
Shapley weights over their subsets are a polynomial, evaluated for all rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import direction
from .training import vectors


def leaves(model: GBTClassificationModel) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Every leaf of the ensemble: its weighted value and, per feature on its path, (feature, low, high, cover share): the row agrees if low < x <= high."""
    out = []

    def walk(node, weight, path, cover):
        if node.getClass().getSimpleName() == "LeafNode":
            out.append((weight * node.prediction(), [(f, *v) for f, v in path.items()]))
            return
        split = node.split()
        if not split.getClass().getSimpleName().startswith("Continuous"):
            raise ValueError("categorical splits aren't explained")
        f, t = split.featureIndex(), split.threshold()
        for child, low, high in ((node.leftChild(), -np.inf, t), (node.rightChild(), t, np.inf)):
            share = child.impurityStats().count() / cover if cover else 0.0
            a, b, c = path.get(f, (-np.inf, np.inf, 1.0))
            walk(child, weight, path | {f: (max(a, low), min(b, high), c * share)}, child.impurityStats().count())

    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        root = tree._java_obj.rootNode()
        walk(root, weight, {}, root.impurityStats().count())
    return out


def shapley(x: np.ndarray, parts: Sequence[tuple[float, list[tuple[int, float, float, float]]]]) -> tuple[np.ndarray, float]:
    """Attributions of the rows of x, and the base value; they sum to the margin."""
    phi = np.zeros(x.shape)
    base = 0.0
    for value, path in parts:
        m = len(path)
        base += value * float(np.prod([c for *_, c in path])) if path else value
        if not m:
            continue
        ones = np.stack([((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, low, high, _ in path])
        covers = np.array([c for *_, c in path])
        for i, (f, *_) in enumerate(path):
            # coefficients, by size, of the product over the others of (cover out of the set, 0/1 in it)
            poly = np.zeros((m, x.shape[0]))
            poly[0] = 1.0
            for j in range(m):
                if j != i:
                    poly[1:] = poly[1:] * covers[j] + poly[:-1] * ones[j]
                    poly[0] = poly[0] * covers[j]
            weight = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
            phi[:, f] += value * (ones[i] - covers[i]) * (weight[:, None] * poly).sum(0)
    return phi, base


def explain(model: GBTClassificationModel, df: DataFrame, id_col: str, features: Sequence[str], top: int = 10) -> DataFrame:
    """(id, rank, feature, shap_value, direction, original_value): the strongest attributions of each row; a feature and its missing mark count as one."""
    parts, names = leaves(model), list(features)
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("rank", T.IntegerType()), T.StructField("feature", T.StringType()), T.StructField("shap_value", T.DoubleType()), T.StructField("original_value", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, 2 * len(names)))
            phi, _ = shapley(x, parts)
            phi = phi[:, : len(names)] + phi[:, len(names) :]
            k = min(top, len(names))
            order = np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :k]
            original = np.where(x[:, len(names) :] > 0, np.nan, x[:, : len(names)])
            yield pd.DataFrame({id_col: np.repeat(pdf[id_col].to_numpy(), k), "rank": np.tile(np.arange(1, k + 1, dtype=np.int32), len(pdf)), "feature": np.array(names, object)[order].ravel(), "shap_value": np.take_along_axis(phi, order, 1).ravel().round(6), "original_value": np.take_along_axis(original, order, 1).ravel()})

    from pyspark.ml.functions import vector_to_array

    out = vectors(df, features).select(id_col, vector_to_array("features").alias("x")).mapInPandas(run, schema)
    return out.withColumn("direction", direction(F.col("shap_value"))).withColumn("original_value", F.nanvl("original_value", F.lit(None).cast("double")))

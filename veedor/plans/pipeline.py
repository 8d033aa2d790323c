"""The offline build as a graph of named tables, each built once from declared inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..models import training
from ..operators import features, flags, labels, ranking, registry, thresholds
from ..sources.reader import read_table
from ..sources.store import ArtifactStore

MODELS = ("M1", "M2", "M3", "M4")


@dataclass(frozen=True)
class Step:
    name: str
    needs: tuple[str, ...]
    build: Callable[[Pipeline], DataFrame]


class Pipeline:
    """Builds steps in the order of their needs. A step whose table exists is read, unless it is forced."""

    def __init__(self, spark: SparkSession, config: EngineConfig = EngineConfig()):
        self.spark, self.config = spark, config
        self.store = ArtifactStore(spark, config.path("artifacts", "").rstrip("/"))
        self.steps = {s.name: s for s in STEPS}
        self.trained: dict[str, training.Trained] = {}

    def source(self, name: str) -> DataFrame:
        return read_table(self.spark, name, self.config)

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    def order(self, wanted: Iterable[str] | None = None) -> list[str]:
        out: list[str] = []

        def visit(name: str) -> None:
            if name not in out:
                for n in self.steps[name].needs:
                    visit(n)
                out.append(name)

        for name in wanted or self.steps:
            visit(name)
        return out

    def run(self, wanted: Iterable[str] | None = None, force: bool = False, start_from: str | None = None) -> dict[str, DataFrame]:
        """Tables by step. start_from: that step and all after it in the order are built again."""
        order = self.order(wanted)
        if start_from is not None and start_from not in order:
            raise ValueError(f"unknown step: {start_from}; there are {', '.join(order)}")
        again = order[order.index(start_from) :] if start_from else order if force else []
        return {name: self.store.get_or_build(name, lambda n=name: self.steps[n].build(self), name in again) for name in order}


def _registry(p: Pipeline) -> DataFrame:
    known, rejected = registry.registry_from_tables({n: p.source(n) for n in ("boletines", "siri", "resp_fiscales", "multas", "colusiones")})
    p.store.write_csv("registry_rejected.csv", rejected)
    return known


def _labels(p: Pipeline) -> DataFrame:
    return labels.build_labels(p.source("contratos").withColumn("Valor del Contrato", F.col("`Valor del Contrato`").cast("string")), p.source("adiciones"), p.source("boletines"), p.table("registry"), p.config.rules)


def _contracts(p: Pipeline) -> DataFrame:
    return features.typed_contracts(p.source("contratos"))


def _raw_features(p: Pipeline) -> DataFrame:
    return features.raw_features(p.table("contracts"), features.typed_processes(p.source("procesos")), features.registrations(p.source("proveedores")), p.table("labels"), p.source("ofertas"))


def _thresholds(p: Pipeline) -> DataFrame:
    measured = p.table("raw_features").filter("firma is not null").select("tipo_contrato", "num_contratos_previos_nacional", F.col("dias_publicidad_bruto").alias("dias_publicidad"), F.col("dias_decision_bruto").alias("dias_decision"), "valor_contrato")
    return thresholds.calibrate(measured, "tipo_contrato", min_count=p.config.rules.min_group)


def _rules(p: Pipeline) -> DataFrame:
    """Flags and scores of every contract with a signing date."""
    rows = p.table("raw_features").filter("firma is not null")
    out = thresholds.attach_thresholds(rows, p.table("thresholds"), "tipo_contrato", flags.WANTED, p.config.rules.default_thresholds)
    out = flags.rule_scores(flags.rule_flags(out, p.config.rules))
    return out.select("id_contrato", *flags.FLAGS, *flags.SCORES, "curtosis_licitacion", "diferencia_relativa_norm", "n_bids")


def _features(p: Pipeline) -> DataFrame:
    """The matrix of every contract whose required fields are there."""
    raw = p.table("raw_features").filter(features.drop_reason().isNull())
    fitted = features.Fitted(p.table("thresholds"), features.fit(raw, p.config.rules).codes)
    return features.feature_matrix(raw, fitted, p.config.rules)


def _train(p: Pipeline) -> DataFrame:
    """Trains every model that has both classes; a row of results each."""
    rows = []
    n, k = (5, 3) if p.config.quick else (20, p.config.cv_folds)
    for label in MODELS:
        data = p.table("features").join(p.table("labels").select("id_contrato", F.col(label).cast("int").alias("y")), "id_contrato").filter("y is not null")
        if data.select("y").distinct().count() < 2:
            continue
        got = training.train(data, "id_contrato", "y", list(features.FEATURES), training.TrainConfig(n_candidates=n, folds=k, seed=p.config.seed))
        got.model.write().overwrite().save(p.store.path(f"models/{label}"))
        p.store.write_json(f"models/{label}.json", got.report())
        p.store.write(f"models/{label}_test", got.score(got.test).select("id_contrato", "y", "score"))
        p.trained[label] = got
        rows.append((label, got.strategy, float(got.cv_auc)))
    return p.spark.createDataFrame(rows, "model string, strategy string, cv_auc double")


def _evaluate(p: Pipeline) -> DataFrame:
    """(model, metric, k, value) of every trained model."""
    out = p.spark.createDataFrame([], "model string, metric string, k int, value double")
    for r in p.table("training").collect():  # four rows at most
        scored = p.table(f"models/{r['model']}_test")
        parts = training.evaluate(scored, "score", "y", "id_contrato")
        for name, table in parts.items():
            p.store.write(f"evaluation/{r['model']}_{name}", table)
        single = [(n, F.lit(None).cast("int"), c, parts[n]) for n, c in (("auc", "auc"), ("average_precision", "ap"))] + [("calibration", F.lit(None).cast("int"), c, parts["calibration"]) for c in ("brier", "baseline", "skill")]
        single += [("map", F.col("k"), "map", parts["map"]), ("ndcg", F.col("k"), "ndcg", parts["ndcg"]), ("recall", F.col("k"), "recall", parts["recall_precision"]), ("precision", F.col("k"), "precision", parts["recall_precision"])]
        for name, k, column, table in single:
            metric = column if name == "calibration" else name
            out = out.unionByName(table.select(F.lit(r["model"]).alias("model"), F.lit(metric).alias("metric"), k.cast("int").alias("k"), F.col(column).cast("double").alias("value")))
    return out


STEPS = (
    Step("registry", (), _registry),
    Step("labels", ("registry",), _labels),
    Step("contracts", (), _contracts),
    Step("raw_features", ("contracts", "labels"), _raw_features),
    Step("thresholds", ("raw_features",), _thresholds),
    Step("rules", ("raw_features", "thresholds"), _rules),
    Step("features", ("raw_features", "thresholds"), _features),
    Step("training", ("features", "labels"), _train),
    Step("evaluation", ("training",), _evaluate),
)


def compare(store_old: ArtifactStore, store_new: ArtifactStore) -> DataFrame:
    """What evaluation metrics changed between two builds."""
    rows = lambda s: s.read("evaluation").withColumn("metric", F.concat_ws("@", "metric", "k"))
    return ranking.metric_delta(rows(store_old), rows(store_new))


def markdown_summary(evaluation: DataFrame) -> str:
    """A table of all metrics by model; it is as small as the models are few."""
    wide = evaluation.select("model", F.concat_ws("@", "metric", "k").alias("metric"), F.round("value", 4).alias("value")).groupBy("metric").pivot("model").agg(F.first("value")).orderBy("metric")
    lines = ["| " + " | ".join(wide.columns) + " |", "|" + "---|" * len(wide.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in wide.collect()])



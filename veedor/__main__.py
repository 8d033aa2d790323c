"""python -m veedor STEP [--force] [--from STEP] [--quick]: build, train, evaluate, validate, compare."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from .config import EngineConfig
from .plans.pipeline import STEPS, Pipeline, compare, markdown_summary
from .sources.reader import validate_folder
from .sources.specs import SPECS
from .sources.store import ArtifactStore

ALIASES = {"build-rcac": "registry", "build-labels": "labels", "build-features": "features", "build-iric": "rules", "train": "training", "evaluate": "evaluation", "run-pipeline": "evaluation"}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="veedor", description=__doc__)
    parser.add_argument("step", choices=[*ALIASES, *(s.name for s in STEPS), "validate", "compare"])
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--from", dest="start", default=None)
    parser.add_argument("--quick", action="store_true")
    parser.add_argument("--root", default=None)
    parser.add_argument("--old", default=None, help="artifacts of another build, to compare with")
    got = parser.parse_args(args)
    config = replace(EngineConfig(), quick=got.quick, **({"root": got.root} if got.root else {}))
    spark = SparkSession.builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    pipeline = Pipeline(spark, config)
    if got.step == "validate":
        found = validate_folder(spark, config, SPECS)
        print("\n".join(f"{k}: {v}" for k, v in found.items()))
        return int(any(v != "ok" for v in found.values()))
    if got.step == "compare":
        compare(ArtifactStore(spark, got.old), pipeline.store).show(200, False)
        return 0
    step = ALIASES.get(got.step, got.step)
    out = pipeline.run([step], got.force, got.start)
    print(markdown_summary(out["evaluation"]) if step == "evaluation" else f"{step}: {out[step].count()} rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

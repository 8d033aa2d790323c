"""What the rules of the engine depend on, in two immutable objects."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from datetime import date
from pathlib import Path

# --- fixed values: they must be these for right results -----------------------------------------

#: Parts of a name that mark a company.
COMPANY_KEYWORDS = ("LTDA", "SAS", "S.A.S", "S.A.", "COOPERATIVA", "FUNDACION", "CORPORACION", "ASOCIACION", "UNION TEMPORAL", "CONSORCIO", "E.S.P", "E.S.E", "E.I.C.E", "SOCIEDAD")

#: Modalities, lower case and without accents, that raise the flags of direct award and special regime.
DIRECT_MODALITIES = ("contratacion directa", "contratacion directa (con ofertas)")
SPECIAL_MODALITIES = ("contratacion regimen especial", "contratacion regimen especial (con ofertas)")

#: Election days.
ELECTION_DAYS = ("2015-10-25", "2018-03-11", "2018-05-27", "2018-06-17", "2019-10-27", "2022-03-13", "2022-05-29", "2022-06-19", "2023-10-29", "2026-03-08", "2026-05-31")

#: Thresholds where neither the type nor the rest group has one.
DEFAULT_THRESHOLDS = {
    ("dias_publicidad", "p99"): 14.0,
    ("dias_decision", "p95"): 43.0,
    ("num_contratos_previos_nacional", "p95"): 3.0,
    ("valor_contrato", "p99"): 500_000_000.0,
}

#: Amendment types.
VALUE_AMENDMENTS = ("ADICION EN EL VALOR", "REDUCCION EN EL VALOR")
TIME_AMENDMENTS = ("EXTENSION",)

#: Without these a contract has no features.
REQUIRED_FIELDS = ("Fecha de Firma", "Valor del Contrato", "Tipo de Contrato", "Modalidad de Contratacion")

#: The composite score.
SCORE_WEIGHTS = {"m1_cost_overruns": 0.20, "m2_delays": 0.20, "m3_comptroller": 0.20, "m4_fines": 0.20, "iric": 0.20}
RISK_BANDS = (("Very Low", 0.0, 0.2), ("Low", 0.2, 0.4), ("Medium", 0.4, 0.6), ("High", 0.6, 0.8), ("Very High", 0.8, 1.0))

# -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleSet:
    company_keywords: tuple[str, ...] = COMPANY_KEYWORDS
    direct_modalities: tuple[str, ...] = DIRECT_MODALITIES
    special_modalities: tuple[str, ...] = SPECIAL_MODALITIES
    election_days: tuple[date, ...] = tuple(map(date.fromisoformat, ELECTION_DAYS))
    default_thresholds: dict[tuple[str, str], float] = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    value_amendments: tuple[str, ...] = VALUE_AMENDMENTS
    time_amendments: tuple[str, ...] = TIME_AMENDMENTS
    required_fields: tuple[str, ...] = REQUIRED_FIELDS
    min_group: int = 30  # rows of a contract type with thresholds of its own
    min_share: float = 0.001  # of all rows, for a category with a code of its own
    score_weights: dict[str, float] = field(default_factory=lambda: dict(SCORE_WEIGHTS))
    risk_bands: tuple[tuple[str, float, float], ...] = RISK_BANDS


@dataclass(frozen=True)
class EngineConfig:
    """Where tables and artifacts are. Environment variables override the folders."""

    root: str = field(default_factory=lambda: os.environ.get("VEEDOR_ROOT", "."))
    secop_dir: str = field(default_factory=lambda: os.environ.get("VEEDOR_SECOP_DIR", "secop"))
    paco_dir: str = field(default_factory=lambda: os.environ.get("VEEDOR_PACO_DIR", "paco"))
    artifacts_dir: str = field(default_factory=lambda: os.environ.get("VEEDOR_ARTIFACTS_DIR", "artifacts"))
    encoding: str = "UTF-8"
    seed: int = 42
    cv_folds: int = 5
    quick: bool = False
    rules: RuleSet = field(default_factory=RuleSet)

    def path(self, folder: str, name: str) -> str:
        base = {"secop": self.secop_dir, "paco": self.paco_dir, "artifacts": self.artifacts_dir}[folder]
        return f"{base.rstrip('/')}/{name}" if base.startswith("/") or "://" in base else f"{self.root.rstrip('/')}/{base}/{name}"


def load_score_config(path: str) -> RuleSet:
    """A rule set with weights and bands from a JSON file: weights by name, ``risk_thresholds`` as name to [low, high]."""
    found = json.loads(Path(path).read_text(encoding="utf-8"))
    bands = tuple(sorted(((k.replace("_", " ").title(), *map(float, v)) for k, v in found.pop("risk_thresholds").items()), key=lambda b: b[1]))
    return RuleSet(score_weights={k: float(v) for k, v in found.items()}, risk_bands=bands)

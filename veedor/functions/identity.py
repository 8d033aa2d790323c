"""Identity numbers and document types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import COMPANY_KEYWORDS
from .text import strip_accents


def normalize_number(c: Column) -> Column:
    """Digits only, check digit included; null is empty."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[^0-9]", "")


def is_malformed(number: Column) -> Column:
    """A normalised number that is empty, all zeros or shorter than 3."""
    return (F.length(number) < 3) | number.rlike("^0+$")


def reject_reason(number: Column) -> Column:
    return F.when(number == "", "empty").when(number.rlike("^0+$"), "all_zeros").when(F.length(number) < 3, "too_short")


def normalize_type(c: Column) -> Column:
    """CC, NIT, CE, PASAPORTE or OTRO; the first rule that fits decides."""
    t = strip_accents(F.upper(F.trim(F.coalesce(c, F.lit("")))))
    has = t.contains
    return (
        F.when(t.isin("CC", "NIT", "PASAPORTE"), t)
        .when(has("CEDULA DE CIUDADANIA"), "CC")
        .when(has("PERSONA") & has("JURIDICA"), "NIT")
        .when(has("PERSONA") & has("NATURAL"), "CC")
        .when(has("CEDULA") & has("EXTRANJERIA"), "CE")
        .otherwise("OTRO")
    )


def infer_type(name: Column, number: Column, keywords: tuple[str, ...] = COMPANY_KEYWORDS) -> Column:
    """NIT for a company's name or a number of 9 digits and more, else CC."""
    company = F.upper(F.coalesce(name, F.lit(""))).rlike("|".join(map(re.escape, keywords)))
    return F.when(company | (F.length(number) >= 9), "NIT").otherwise("CC")

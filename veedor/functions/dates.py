"""Dates, durations and calendars. Bad text is null, never an error."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAYS = {"dia": 1.0, "mes": 30.0, "año": 365.0, "semana": 7.0, "hora": 1 / 24}


def _iso(c: Column) -> Column:
    head = F.substring(F.trim(c), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def _us(c: Column) -> Column:
    """Month/day/year; what follows the four digits of the year is ignored."""
    return F.try_to_date(F.regexp_extract(F.trim(c), r"^(\d{1,2}/\d{1,2}/\d{4})", 1), "M/d/yyyy")


def parse_date(c: Column) -> Column:
    """ISO first, then month/day/year."""
    return F.coalesce(_iso(c), F.when(F.trim(c).rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _us(c)))


def parse_registration_date(c: Column) -> Column:
    """Month/day/year first, then ISO."""
    return F.coalesce(F.when(F.trim(c).rlike(r"^\d{1,2}/\d{1,2}/\d{4}"), _us(c)), _iso(c))


def parse_duration(c: Column) -> Column:
    """Days of ``143 Dia(s)``, ``12 Mes(es)`` and the like, rounded half to even."""
    pattern = r"(?i)^(\d+)\s+(dia|mes|año|semana|hora)\((?:s|es)\)$"
    t = F.trim(c)
    unit = F.lower(F.regexp_extract(t, pattern, 2))
    factor = F.lit(None).cast("double")
    for name, days in _DAYS.items():
        factor = F.when(unit == name, days).otherwise(factor)
    return F.bround(F.regexp_extract(t, pattern, 1).try_cast("double") * factor)


def day_number(d: Column) -> Column:
    return F.datediff(d.cast("date"), F.lit("1970-01-01").cast("date"))


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def days_clamped(end: Column, start: Column) -> Column:
    """max(0, end - start), null if either is."""
    d = F.datediff(end, start)
    return F.when(d.isNotNull(), F.greatest(d, F.lit(0)))


def days_to_next(d: Column, days: tuple[date, ...]) -> Column:
    """Days to the first of some days that isn't before d; null after the last."""
    calendar = F.array(*map(F.lit, sorted(days)))
    return F.datediff(F.array_min(F.filter(calendar, lambda e: e >= d)), d)

"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_currency(c: Column) -> Column:
    """``$1,234.50`` as a double; bad text is null."""
    return F.regexp_replace(c.cast("string"), r"[\$,]", "").try_cast("double")


def count_or_zero(c: Column) -> Column:
    """``1,826`` as a number, 0 where there is none."""
    return F.coalesce(F.regexp_replace(c.cast("string"), ",", "").try_cast("double"), F.lit(0.0))


def parse_count(c: Column) -> Column:
    """An integer from text or a double, cut towards zero; null where there is none."""
    number = c.cast("string").try_cast("double")
    return F.when(~F.isnan(number), number.try_cast("int"))

"""Text expressions. Column in, Column out; no actions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTED = "ÁÀÄÂÃÅÇÉÈËÊÍÌÏÎÑÓÒÖÔÕÚÙÜÛÝáàäâãåçéèëêíìïîñóòöôõúùüûýÿ"
_PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"


def strip_accents(c: Column) -> Column:
    """Letters of the Latin range without their accents; combining marks go."""
    return F.translate(F.regexp_replace(c, r"[̀-ͯ]", ""), _ACCENTED, _PLAIN)


def fold(c: Column) -> Column:
    """Lower case, trimmed, without accents; null becomes empty."""
    return strip_accents(F.lower(F.trim(F.coalesce(c, F.lit("")))))


def normalize_name(c: Column) -> Column:
    """Upper case, without accents, anything but letters and digits as one blank."""
    plain = F.regexp_replace(strip_accents(F.upper(F.coalesce(c, F.lit("")))), "[^A-Z0-9]+", " ")
    return F.trim(plain)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def text_key(c: Column) -> Column:
    """A join key: trimmed, null where blank or the spelled-out nulls of other tools."""
    t = F.trim(c)
    return F.when((t != "") & ~t.isin("nan", "None"), t)


def unspsc_segment(c: Column) -> Column:
    """The two digits after an optional ``V1.``, as a number."""
    code = F.regexp_replace(F.trim(c), r"(?i)^V1\.", "")
    return F.when(F.length(code) >= 2, F.substring(code, 1, 2).try_cast("int"))


def has_justification(c: Column) -> Column:
    """0 for null, blank, ``N/A`` and ``No definido``, else 1."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t.isin("", "n/a", "no definido"), 0).otherwise(1)


def _lowered(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def is_direct_award(modality: Column) -> Column:
    t = _lowered(modality)
    return (t.contains("contrataci") & t.contains("directa")).cast("int")


def is_special_regime(modality: Column) -> Column:
    t = _lowered(modality)
    return (t.contains("r") & t.contains("gimen especial")).cast("int")


def is_professional_services(justification: Column) -> Column:
    return _lowered(justification).contains("servicios profesionales").cast("int")


def in_modalities(modality: Column, names: tuple[str, ...]) -> Column:
    return fold(modality).isin(*names).cast("int")

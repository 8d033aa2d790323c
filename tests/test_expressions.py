import datetime as dt

import pytest
from pyspark.sql import functions as F

from veedor.config import RuleSet
from veedor.functions import dates, identity, money, scoring, text


def check(spark, build, cases, kind="string"):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], f"i int, x {kind}")
    got = [r[0] for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").select("y").collect()]
    assert got == [b for _, b in cases]


def test_numbers_and_types(spark):
    check(spark, identity.normalize_number, [("51.704.388", "51704388"), ("900310257-1", "9003102571"), ("CE 289910", "289910"), (None, "")])
    check(spark, lambda c: identity.reject_reason(identity.normalize_number(c)), [("", "empty"), ("00", "all_zeros"), ("12", "too_short"), ("123", None), (None, "empty")])
    check(spark, identity.normalize_type, [("cc", "CC"), (" Cédula de Ciudadanía", "CC"), ("Persona Jurídica", "NIT"), ("PERSONA NATURAL", "CC"), ("cedula de extranjeria", "CE"), ("CE", "OTRO"), ("pasaporte", "PASAPORTE"), (None, "OTRO")])
    check(spark, lambda c: identity.infer_type(c, F.lit("51704388")), [("LUCIA MORENO", "CC"), ("EMPRESA SAS", "NIT"), (None, "CC"), ("x S.A.", "NIT"), ("x SxA ", "CC")])
    check(spark, lambda c: identity.infer_type(F.lit(None).cast("string"), c), [("900417306", "NIT"), ("23456709", "CC")])


def test_money(spark):
    check(spark, money.clean_currency, [("$10,979,236,356", 10979236356.0), ("5.5", 5.5), ("bad", None), ("", None), (None, None)])
    check(spark, money.count_or_zero, [("1,826", 1826.0), ("", 0.0), (None, 0.0)])
    check(spark, money.parse_count, [("3", 3), ("3.0", 3), ("x", None), ("NaN", None), (None, None)])


def test_dates(spark):
    d = dt.date(2023, 1, 5)
    check(spark, dates.parse_date, [("2023-01-05", d), ("2023-01-05T10:00:00", d), ("01/05/2023", d), ("2023-1-5", None), ("x", None), (None, None), ("", None)])
    check(spark, dates.parse_registration_date, [("1/5/2023", d), ("01/05/2023 10:00", d), ("2023-01-05", d), ("13/45/2023", None)])
    check(spark, dates.parse_duration, [("143 Dia(s)", 143.0), ("12 Mes(es)", 360.0), ("1 Año(s)", 365.0), ("2 semana(s)", 14.0), ("36 Hora(s)", 2.0), ("12 Hora(s)", 0.0), ("No definido", None), ("5 Dia", None), (None, None)])
    days = RuleSet().election_days
    check(spark, lambda c: dates.days_to_next(c.cast("date"), days), [("2015-10-25", 0), ("2015-10-26", 867), ("2026-06-01", None), (None, None)])
    check(spark, lambda c: dates.days_clamped(F.lit("2020-01-10").cast("date"), c.cast("date")), [("2020-01-01", 9), ("2020-02-01", 0), (None, None)])


def test_text(spark):
    check(spark, text.unspsc_segment, [("V1.80111600", 80), ("v1.72", 72), ("7", None), ("xx11", None), (None, None)])
    check(spark, text.has_justification, [(None, 0), ("", 0), ("n/a", 0), ("No Definido", 0), ("x", 1)])
    check(spark, text.strip_accents, [("CÉDULA ñandú Straße", "CEDULA nandu Straße"), ("é", "e")])
    check(spark, text.is_direct_award, [("Contratación directa", 1), ("Licitación", 0), (None, 0)])
    check(spark, lambda c: text.in_modalities(c, RuleSet().special_modalities), [("Contratación Régimen Especial", 1), ("regimen especial", 0), (None, 0)])
    check(spark, text.normalize_name, [("  Compañía, S.A.S. ", "COMPANIA S A S"), (None, "")])
    check(spark, text.text_key, [(" a ", "a"), ("nan", None), ("", None), (None, None)])


@pytest.mark.parametrize(("score", "band"), [(0.0, "Very Low"), (0.2, "Low"), (0.4, "Medium"), (0.6, "High"), (0.8, "Very High"), (1.0, "Very High"), (1.01, None), (-0.1, None)])
def test_bands(spark, score, band):
    assert spark.range(1).select(scoring.risk_band(F.lit(score))).first()[0] == band


def test_composite_score_and_document(spark):
    inputs = {k: F.lit(1.0) for k in ("m1_cost_overruns", "m2_delays", "m3_comptroller")} | {"m4_fines": F.lit(None).cast("double"), "iric": F.lit(0.5)}
    assert spark.range(1).select(scoring.composite_score(inputs)).first()[0] == pytest.approx(0.7)
    assert spark.range(1).select(scoring.document(b=F.lit("ñ"), a=F.lit(None).cast("int"))).first()[0] == '{"a":null,"b":"ñ"}'

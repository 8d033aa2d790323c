import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veedor.operators import bids, dedupe, encoding, flags, graph, history, labels, ranking, registry, reshape, thresholds


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_winners_keep_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", "y", 3)], "k string, v string, ord int")
    assert rows(dedupe.keep_first(df, ["k"], ["ord"]).select("k", "v")) == [("a", None), ("b", "y")]
    assert rows(dedupe.keep_last(df, ["k"], ["ord"]).select("k", "v")) == [("a", "x"), ("b", "y")]
    with pytest.raises(ValueError, match="not unique"):
        dedupe.assert_unique(df, ["k"])


def test_history_of_the_fixture(spark):
    data = [("A1", "900111111", "Cundinamarca", 18262, 1e6, 1, 0), ("A2", "900111111", "Antioquia", 18793, 2e6, 0, 1), ("A3", "900111111", "Cundinamarca", 19061, 5e5, 1, 0), ("B1", "800222222", "Antioquia", 18444, 3e6, 0, 0), ("A4", "900111111", None, 19061, None, 0, 0)]
    df = spark.createDataFrame(data, "id string, num string, dept string, day int, value double, m1 int, m2 int")
    got = {r["id"]: r for r in history.attach_history(df, ["num"], "day", {"total": "value", "late": "m2"}).collect()}
    assert [(got[k]["n_prior"], got[k]["total"], got[k]["late"]) for k in ("A1", "A2", "A3", "A4", "B1")] == [(0, 0, 0), (1, 1e6, 0), (2, 3e6, 1), (2, 3e6, 1), (0, 0, 0)]
    here = {r["id"]: r for r in history.attach_history(df, ["num", "dept"], "day", {"total": "value"}, valid=F.col("dept").isNotNull()).collect()}
    assert [here[k]["n_prior"] for k in ("A1", "A2", "A3", "A4")] == [0, 0, 1, 0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(0, 9)), min_size=1, max_size=30))
def test_history_equals_brute_force(spark, data):
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(data)], "id int, p int, day int, v int")
    got = {r["id"]: (r["n_prior"], r["s"]) for r in history.attach_history(df, ["p"], "day", {"s": "v"}).collect()}
    probe = {r["id"]: (r["n_prior"], r["s"]) for r in history.probe_history(df.drop("v"), df, ["p"], "day", {"s": "v"}).collect()}
    for i, (p, d, _) in enumerate(data):
        past = [v for q, e, v in data if q == p and e < d]
        assert got[i] == probe[i] == (len(past), sum(past))


def test_bids(spark):
    data = [("a", float(x)) for x in (100, 200, 300, 400)] + [("b", 5.0), ("b", 5.0), ("b", 7.0)] + [("c", 1.0), ("c", 0.0), ("c", -1.0), ("c", float("nan"))] + [("d", 2.0)] * 4 + [(None, 1.0), ("e", None)]
    got = {r[0]: r for r in bids.bid_stats(spark.createDataFrame(data, "k string, v double"), "k", "v").collect()}
    assert got["a"][1] == pytest.approx(-1.2) and got["a"][2] == 1.0 and got["a"][3] == 4
    assert tuple(got["b"])[1:] == (None, 0.0, 3)
    assert tuple(got["c"])[1:] == (None, None, 1)
    assert tuple(got["d"])[1:] == (None, 0.0, 4)
    assert set(got) == {"a", "b", "c", "d"}


def test_thresholds(spark):
    data = [("A", float(i)) for i in range(50)] + [("B", 1000.0 + i) for i in range(5)] + [(None, 5.0)]
    df = spark.createDataFrame(data, "t string, dias_publicidad double")
    long = thresholds.calibrate(df, "t", ("dias_publicidad",))
    got = {(r["t"], r["percentile"]): r["value"] for r in long.collect()}
    assert got["A", "p95"] == pytest.approx(46.55) and got["Otro", "p1"] == pytest.approx(5 + 0.05 * 995)
    out = thresholds.attach_thresholds(spark.createDataFrame([("A",), ("new",), (None,)], "t string"), long, "t", [("dias_publicidad", "p99"), ("valor_contrato", "p99"), ("x", "p1")])
    assert rows(out.select("t", F.round("dias_publicidad_p99", 2), "valor_contrato_p99", "x_p1")) == sorted([("A", 48.51, 5e8, None), ("new", 1003.95, 5e8, None), (None, 1003.95, 5e8, None)], key=str)
    assert thresholds.to_nested(long, "t")["A"]["dias_publicidad"]["p5"] == pytest.approx(2.45)


def test_encoding_is_a_bijection_plus_other(spark):
    df = spark.createDataFrame([(x,) for x in ["b"] * 600 + ["a"] * 399 + ["rare"] + [None] * 100], "c string")
    codes = encoding.category_codes(df, "c")
    assert rows(codes) == [("Other", 0), ("a", 1), ("b", 2)]
    out = encoding.encode(spark.createDataFrame([("a",), ("rare",), (None,), ("b",)], "c string"), "c", codes, "code")
    assert rows(out) == sorted([("a", 1), ("rare", 0), (None, None), ("b", 2)], key=str)
    assert rows(out.select(encoding.code_lookup(F.col("c"), {"a": 1, "b": 2}))) == sorted([(1,), (0,), (None,), (2,)], key=str)


BASE = {"has_process": True, "num_proponentes": 3, "n_segments": 1, "num_contratos_previos_nacional": 2, "modalidad": "Licitacion publica", "dias_publicidad_bruto": 5, "dias_decision_bruto": 10, "doc_type": "NIT", "doc_number": "900310257", "justificacion": "Por necesidad institucional", "valor_contrato": 1e7, "num_sobrecostos_previos": 0, "num_retrasos_previos": 0, "num_contratos_previos_nacional_p95": 3.0, "dias_publicidad_p99": 14.0, "dias_decision_p95": 43.0, "valor_contrato_p99": 2.2e8}
KINDS = "has_process boolean, num_proponentes int, n_segments int, num_contratos_previos_nacional int, modalidad string, dias_publicidad_bruto int, dias_decision_bruto int, doc_type string, doc_number string, justificacion string, valor_contrato double, num_sobrecostos_previos int, num_retrasos_previos int, num_contratos_previos_nacional_p95 double, dias_publicidad_p99 double, dias_decision_p95 double, valor_contrato_p99 double"
CASES = [
    ({}, {}),
    ({"num_proponentes": 1}, {"unico_proponente": 1}),
    ({"num_proponentes": None}, {"unico_proponente": 1}),
    ({"n_segments": 2}, {"proveedor_multiproposito": 1}),
    ({"num_contratos_previos_nacional": 4}, {"historial_proveedor_alto": 1}),
    ({"modalidad": "Contratación directa (con ofertas)"}, {"contratacion_directa": 1}),
    ({"modalidad": "Contratación régimen especial"}, {"regimen_especial": 1}),
    ({"dias_publicidad_bruto": 0}, {"periodo_publicidad_extremo": 1}),
    ({"dias_publicidad_bruto": 15}, {"periodo_publicidad_extremo": 1}),
    ({"dias_publicidad_bruto": -1}, {}),
    ({"dias_publicidad_bruto": None}, {"periodo_publicidad_extremo": None}),
    ({"doc_type": "No Definido"}, {"datos_faltantes": 1}),
    ({"doc_number": "12345"}, {"datos_faltantes": 1}),
    ({"justificacion": " No especificado"}, {"datos_faltantes": 1}),
    ({"valor_contrato": 3e8}, {"datos_faltantes": 1}),
    ({"dias_decision_bruto": 44}, {"periodo_decision_extremo": 1}),
    ({"num_sobrecostos_previos": 1}, {"proveedor_sobrecostos_previos": 1}),
    ({"num_retrasos_previos": 1}, {"proveedor_retrasos_previos": 1}),
    ({"has_process": False}, {"ausencia_proceso": 1, "unico_proponente": None, "periodo_publicidad_extremo": None, "periodo_decision_extremo": None}),
]


def test_flags(spark):
    names = list(BASE)
    df = spark.createDataFrame([(i, *((BASE | change)[n] for n in names)) for i, (change, _) in enumerate(CASES)], "i int, " + KINDS)
    got = {r["i"]: r for r in flags.rule_scores(flags.rule_flags(df)).collect()}
    for i, (_, want) in enumerate(CASES):
        assert {f: got[i][f] for f in flags.FLAGS} == dict.fromkeys(flags.FLAGS, 0) | want, CASES[i]
        assert got[i]["iric_score"] == pytest.approx(sum(v or 0 for v in want.values()) / 11)
    assert got[0]["iric_score"] == 0


def test_registry_of_the_fixture(spark):
    make = lambda data, cols: spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    tables = {
        "boletines": make([("CC", "23456709"), ("NIT", "900310257"), ("CC", "000000")], ["tipo de documento", "numero de documento"]),
        "siri": make([("CEDULA DE CIUDADANIA", "23456709"), ("NIT", "900821640")], ["tipo_documento", "numero_documento"]),
        "resp_fiscales": make([("51704388", "LUCIA MORENO"), ("900417306", "EMPRESA SAS")], ["Tipo y Num Docuemento", "Responsable Fiscal"]),
        "multas": make([("70315562", "JORGE ACOSTA"), ("901702845", "VIVEROS LTDA")], ["col_5", "col_6"]),
        "colusiones": make([("NIT", "800230971")], ["Tipo de Persona Sancionada", "Identificacion"]),
    }
    known, rejected = registry.registry_from_tables(tables)
    assert known.count() == 8
    both = known.filter("numero_documento = '23456709'").first()
    assert (both["en_boletines"], both["en_siri"], both["num_fuentes_distintas"]) == (True, True, 2)
    assert [r["reason"] for r in rejected.collect()] == ["all_zeros"]
    probe = spark.createDataFrame([("cc", "23.456.709"), ("cc", "1")], "tipo string, numero string")
    assert rows(registry.find_identities(known, probe).select("numero", "en_siri")) == [("1", None), ("23.456.709", True)]


def test_labels_of_the_fixture(spark):
    c = spark.createDataFrame([("1111", "NIT", "900111111", None, 0), ("1111", "NIT", "900111111", "5", 1), ("2222", "CC", "23456709", "", 2), ("3333", "NIT", None, "1,826", 3)], "`ID Contrato` string, TipoDocProveedor string, `Documento Proveedor` string, `Dias adicionados` string, ord int")
    a = spark.createDataFrame([("1111", "adicion en el valor "), ("2222", "EXTENSION"), ("1111", "MODIFICACION GENERAL"), ("9999", "ADICION EN EL VALOR")], "id_contrato string, tipo string")
    b = spark.createDataFrame([("CC", "23456709"), ("NIT", "111222333")], "`tipo de documento` string, `numero de documento` string")
    r = spark.createDataFrame([("CC", "23456709"), ("NIT", "999999999")], "tipo_documento string, numero_documento string")
    got = labels.build_labels(c, a, b, r)
    assert rows(got.select("id_contrato", "M1", "M2", "M3", "M4")) == [("1111", 1, 0, 0, 0), ("2222", 0, 1, 1, 1), ("3333", 0, 1, None, None)]
    assert labels.unknown_amendments(a, c).count() == 1


def scored(spark, ys, ss):
    return spark.createDataFrame([(i, int(y), float(s)) for i, (y, s) in enumerate(zip(ys, ss, strict=True))], "id int, y int, s double")


def test_ranking_vectors(spark):
    s = [0.9, 0.8, 0.7, 0.4, 0.3, 0.2, 0.1, 0.05]
    perfect, worst, none = scored(spark, [1, 1, 1, 0, 0, 0, 0, 0], s), scored(spark, [0, 0, 0, 0, 0, 1, 1, 1], s), scored(spark, [0] * 8, s)
    assert rows(ranking.mean_average_precision(perfect, "s", "y", "id", (3, 8))) == [(3, 1.0), (8, 1.0)]
    assert rows(ranking.mean_average_precision(worst, "s", "y", "id", (3,))) == [(3, 0.0)]
    assert rows(ranking.mean_average_precision(none, "s", "y", "id", (3,))) == [(3, 0.0)]
    assert rows(ranking.recall_precision(perfect, "s", "y", "id", (2, 100))) == [(100, 1.0, 3 / 8), (2, 2 / 3, 1.0)]
    assert ranking.auc(perfect, "s", "y").first()[0] == 1.0 and ranking.auc(worst, "s", "y").first()[0] == 0.0 and ranking.auc(none, "s", "y").first()[0] is None
    assert rows(ranking.ndcg(perfect, "s", "y", "id", (3,)))[0][1] == pytest.approx(1.0)
    best = ranking.best_threshold(ranking.threshold_sweep(perfect, "s", "y")).first()
    assert best["f1"] == pytest.approx(1.0) and best["threshold"] == 0.45


def test_auc_and_ap_equal_brute_force(spark):
    rng = random.Random(3)
    ys = [rng.random() < 0.3 for _ in range(60)]
    ss = [rng.randint(0, 9) / 10 for _ in ys]
    pos, neg = [s for y, s in zip(ys, ss, strict=True) if y], [s for y, s in zip(ys, ss, strict=True) if not y]
    want = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)) / len(pos) / len(neg)
    df = scored(spark, ys, ss)
    assert ranking.auc(df, "s", "y").first()[0] == pytest.approx(want)
    ap, before = 0.0, 0.0
    for t in sorted(set(ss), reverse=True):
        tp, n = sum(y for y, s in zip(ys, ss, strict=True) if s >= t), sum(s >= t for s in ss)
        ap, before = ap + (tp / len(pos) - before) * tp / n, tp / len(pos)
    assert ranking.average_precision(df, "s", "y").first()[0] == pytest.approx(ap)


def test_attributions(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", -0.9), (1, "c", 0.5), (2, "a", 0.1)], "id int, feature string, value double")
    assert rows(ranking.top_attributions(df, "id", "feature", "value", 2).select("id", "feature", "rank")) == [(1, "a", 2), (1, "b", 1), (2, "a", 1)]
    assert rows(ranking.global_attributions(df, "feature", "value", 1)) == [("b", 0.9)]


def test_reshape(spark):
    df = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("v", 1, "a")], "u string, t int, e string")
    assert rows(reshape.flatten_events(df, "u", ["e"], ["t"], 2)) == [("u", "a", "b"), ("v", "a", None)]
    assert rows(reshape.pivot_counts(df, "u", "e", ("a", "b"))) == [("u", 1, 1), ("v", 1, 0)]


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), (None, "a")], "source string, target string")
    assert rows(graph.components(e)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d")]
    left = spark.createDataFrame([(1, "Constructora Andína S.A.S"), (2, "Otra cosa")], "id int, name string")
    right = spark.createDataFrame([(7, "CONSTRUCTORA ANDINA SAS."), (8, "Nada que ver")], "id int, name string")
    got = graph.ngram_match(left, right, "id", "name", "id", "name", min_similarity=0.6).collect()
    assert [(r["left_id"], r["right_id"]) for r in got] == [(1, 7)]
    assert rows(graph.ego_network(e.dropna(), "a", 2)) == [("a", 0), ("b", 1), ("c", 2)]


def test_empty_tables(spark):
    e = spark.createDataFrame([], "k string, v double, day int, y int, id int")
    assert bids.bid_stats(e, "k", "v").count() == 0
    assert history.attach_history(e, ["k"], "day", {"s": "v"}).count() == 0
    assert ranking.auc(e, "v", "y").first()[0] is None
    assert thresholds.calibrate(e, "k", ("v",)).count() == 0
    assert rows(encoding.category_codes(e, "k")) == [("Other", 0)]

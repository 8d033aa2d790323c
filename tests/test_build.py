"""Sources, the pipeline, models and streaming on small files."""

import csv
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from veedor.config import EngineConfig, RuleSet
from veedor.models import attribution, split, training
from veedor.operators import features
from veedor.plans.pipeline import Pipeline, markdown_summary
from veedor.plans.score import documents, score_contracts
from veedor.sources.reader import bad_rows, read_raw, read_table, resolve_dialect, validate_folder, validate_header
from veedor.sources.specs import SPECS
from veedor.sources.store import ArtifactStore
from veedor.streaming.scoring import score_stream


def write(path, header, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        if header:
            out.writerow(header)
        out.writerows(data)


def full(name, **values):
    return [values.get(c, "") for c in SPECS[name].columns]


CONTRACTS = [
    ("CON-001", "PROC-001", "Prestacion de Servicios", "Contratacion Directa", "NIT", "900111111", "$5,000,000", "Cundinamarca", "V1.80111600", "2022-01-15", "2022-01-20", "350 Dia(s)"),
    ("CON-002", "PROC-002", "Obra", "Licitacion Publica", "NIT", "900111111", "$8,000,000", "Antioquia", "V1.72101500", "2023-03-01", "2023-03-15", "12 Mes(es)"),
    ("CON-003", "PROC-003", "Suministro", "Seleccion Abreviada", "CC", "23456709", "$450,000", "Bolivar", "V1.47101500", "2022-06-01", "2022-06-10", "204 Dia(s)"),
    ("CON-004", "PROC-004", "Consultoria", "Concurso de Meritos", "NIT", "800222222", "$3,000,000", "Valle del Cauca", "V1.80101600", "2021-08-20", "2021-09-01", "12 Mes(es)"),
    ("CON-005", "PROC-005", "Prestacion de Servicios", "Contratacion Directa", "NIT", "900333333", "$1,000,000", "Cundinamarca", "V1.80111600", "", "2022-01-10", "365 Dia(s)"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("build")
    names = ("ID Contrato", "Proceso de Compra", "Tipo de Contrato", "Modalidad de Contratacion", "TipoDocProveedor", "Documento Proveedor", "Valor del Contrato", "Departamento", "Codigo de Categoria Principal", "Fecha de Firma", "Fecha de Inicio del Contrato", "Duración del contrato")
    put = lambda name, data: write(root / SPECS[name].folder / SPECS[name].file, SPECS[name].columns, data)
    put("contratos", [full("contratos", **dict(zip(names, c, strict=True))) for c in CONTRACTS])
    put("procesos", [full("procesos", **{"ID del Portafolio": "PROC-001", "Fecha de Publicacion del Proceso": "2022-01-01", "Fecha de Ultima Publicación": "2022-01-10", "Fecha de Recepcion de Respuestas": "2022-01-08", "Fecha Adjudicacion": "2022-01-12", "Respuestas al Procedimiento": "3", "Proveedores Unicos con Respuestas": "2"})])
    put("ofertas", [full("ofertas", **{"ID del Proceso de Compra": "PROC-001", "Valor de la Oferta": f"${v}"}) for v in (100, 200, 300, 400)])
    put("proveedores", [full("proveedores", NIT="900111111", **{"Fecha Creación": "01/01/2015"})])
    put("boletines", [full("boletines", **{"tipo de documento": "CC", "numero de documento": "23456709"})])
    put("adiciones", [["A1", "CON-001", "ADICION EN EL VALOR", "", "2022-02-01"]])
    put("resp_fiscales", [full("resp_fiscales", **{"Tipo y Num Docuemento": "51704388", "Responsable Fiscal": "LUCIA"})])
    put("colusiones", [full("colusiones", Identificacion="800222222", **{"Tipo de Persona Sancionada": "NIT"})])
    write(root / "paco" / SPECS["siri"].file, None, [[*"abcd", "NIT", "900821640", *["x"] * 22]])
    write(root / "paco" / SPECS["multas"].file, None, [[*"abcde", "70315562", "JORGE", *["x"] * 8]])
    return root


@pytest.fixture(scope="module")
def config(folder):
    return replace(EngineConfig(), root=str(folder), secop_dir="secop", paco_dir="paco", artifacts_dir="artifacts")


def test_specs_name_api_columns():
    c = SPECS["contratos"]
    assert c.api_name("Duración del contrato") == "duraci_n_del_contrato"
    assert c.api_name("Justificacion Modalidad de Contratacion") == "justificacion_modalidad_de"
    assert SPECS["procesos"].api_name("Fecha de Publicacion del Proceso") == "fecha_de_publicacion_del"
    assert SPECS["procesos"].api_name("Nombre del Proveedor Adjudicado") == "nombre_del_proveedor"
    assert {k: len(v.columns) for k, v in SPECS.items()} == {"contratos": 22, "procesos": 23, "ofertas": 7, "proponentes": 9, "proveedores": 25, "boletines": 9, "ejecucion": 16, "suspensiones": 7, "adiciones": 5, "resp_fiscales": 8, "colusiones": 12, "sanciones_penales": 9, "siri": 2, "multas": 15}
    assert resolve_dialect(SPECS["ofertas"], ["modalidad"])["Modalidad"] == "modalidad"
    with pytest.raises(ValueError, match="Valor"):
        validate_header(["Valor"], ["x"])


def test_malformed_files(spark, tmp_path):
    spec = SPECS["adiciones"]
    p = tmp_path / "a.csv"
    p.write_bytes(b"identificador,id_contrato,tipo,descripcion,fecharegistro\nA,1,T\xff,d,x\nB,2,T,d,x,too,many\nC,3,T,d,x\n")
    raw = read_raw(spark, spec, str(p))
    assert bad_rows(raw).count() == 1
    assert [r["tipo"] for r in read_table(spark, "adiciones", path=str(p)).orderBy("identificador").collect()] == ["T�", "T"]
    (tmp_path / "b.csv").write_text("identificador,tipo\nA,1\n")
    with pytest.raises(ValueError, match="id_contrato"):
        read_raw(spark, spec, str(tmp_path / "b.csv"))


def test_pipeline(spark, folder, config):
    p = Pipeline(spark, config)
    assert set(validate_folder(spark, config, ("contratos", "siri", "procesos")).values()) == {"ok"}
    out = p.run(["features", "rules"])
    assert out["registry"].count() == 5
    f = {r["id_contrato"]: r for r in out["features"].collect()}
    assert set(f) == {"CON-001", "CON-002", "CON-003", "CON-004"} and len(features.FEATURES) == 45
    assert out["features"].columns == ["id_contrato", *features.FEATURES]
    one, two = f["CON-001"], f["CON-002"]
    assert (one["dias_publicidad"], one["dias_decision"], one["num_proponentes"], one["dias_firma_a_inicio"], one["duracion_contrato_dias"]) == (7, 5, 2, 5, 350.0)
    assert (two["num_contratos_previos_nacional"], two["valor_total_contratos_previos_nacional"], two["num_contratos_previos_depto"]) == (1, 5e6, 0)
    assert (two["num_sobrecostos_previos"], two["ausencia_proceso"], two["unico_proponente"], one["contratacion_directa"]) == (1, 1, None, 1)
    assert one["unspsc_categoria"] > 0 and one["dias_proveedor_registrado"] == 2571
    rules = {r["id_contrato"]: r for r in out["rules"].collect()}
    assert rules["CON-001"]["curtosis_licitacion"] == pytest.approx(-1.2) and rules["CON-001"]["n_bids"] == 4
    assert p.order(["evaluation"])[-1] == "evaluation"
    with pytest.raises(ValueError, match="unknown step"):
        p.run(["features"], start_from="nothing")
    # a single contract goes the same way
    raw = p.table("raw_features").filter("id_contrato = 'CON-001'")
    fitted = features.Fitted(p.table("thresholds"), features.fit(p.table("raw_features"), RuleSet()).codes)
    assert features.feature_matrix(raw, fitted).count() == 1


def test_store(spark, tmp_path):
    s = ArtifactStore(spark, str(tmp_path))
    calls = []
    build = lambda: calls.append(1) or spark.range(3)
    assert s.get_or_build("t", build).count() == s.get_or_build("t", build).count() == 3 and len(calls) == 1
    s.get_or_build("t", build, force=True)
    assert len(calls) == 2
    s.write_json("a.json", {"ñ": [1]})
    assert s.read_json("a.json") == {"ñ": [1]}


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(5)
    data = [(i, rng.random(), None if i % 7 == 0 else rng.random(), i % 3) for i in range(600)]
    data = [(*r, int(r[1] + (r[2] or 0.5) > 1.2)) for r in data]
    df = spark.createDataFrame(data, "id int, a double, b double, c int, y int")
    return df, training.train(df, "id", "y", ["a", "b", "c"], training.TrainConfig(candidates=({"maxIter": 5, "maxDepth": 3},), folds=2))


def test_split_keeps_shares(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    got = {(r["y"], r["train"]): r["count"] for r in split.stratified_split(df, "y").groupBy("y", "train").count().collect()}
    assert got == {(0, True): 560, (0, False): 240, (1, True): 140, (1, False): 60}


def test_training_and_attribution(spark, trained):
    df, model = trained
    assert model.cv_auc > 0.9 and training.evaluate(model.score(model.test), "score", "y", "id")["auc"].first()[0] > 0.9
    parts = attribution.leaves(model.model)
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.random((50, 3)), np.zeros((50, 3))])
    phi, base = attribution.shapley(x, parts)
    from pyspark.ml.linalg import Vectors

    margin = np.array([sum(v for v, path in parts if all(lo < row[f] <= hi for f, lo, hi, _ in path)) for row in x])
    assert np.allclose(phi.sum(1) + base, margin)
    want = [model.model.predictRaw(Vectors.dense(row))[1] for row in x]
    assert np.allclose(margin, want)
    # exact against the definition, over all subsets
    from itertools import combinations
    from math import factorial

    def value(row, known):
        return sum(v * np.prod([1.0 if f in known and lo < row[f] <= hi else 0.0 if f in known else c for f, lo, hi, c in path]) for v, path in parts)

    row, m = x[0], 6
    for i in range(m):
        others = [j for j in range(m) if j != i]
        exact = sum(factorial(k) * factorial(m - 1 - k) / factorial(m) * (value(row, {*s, i}) - value(row, set(s))) for k in range(m) for s in combinations(others, k))
        assert phi[0, i] == pytest.approx(exact, abs=1e-9)
    top = attribution.explain(model.model, df.limit(4), "id", ["a", "b", "c"], 2)
    assert top.count() == 8 and top.filter("rank > 2").count() == 0


def test_scores_and_documents(spark, trained):
    df, model = trained
    matrix = df.select("id", "a", "b", "c", F.lit(0.5).alias("iric_score")).limit(3)
    out = score_contracts(matrix, {"M1": model}, id_col="id")
    for r in out.collect():
        assert r["cri"] == pytest.approx(0.2 * r["m1_cost_overruns"] + 0.1, abs=1e-6) and r["risk_level"]
    text = documents(out, {"M1": model}, ["a", "b"], "id").first()["document"]
    assert '"cri"' in text and '"shap_value"' in text


def test_streaming(spark, tmp_path):
    from tests.test_operators import BASE, KINDS

    gone = ("num_contratos_previos_nacional", "num_sobrecostos_previos", "num_retrasos_previos", "num_contratos_previos_nacional_p95", "dias_publicidad_p99", "dias_decision_p95", "valor_contrato_p99")
    kinds = ", ".join(k for k in KINDS.split(", ") if k.split()[0] not in gone) + ", tipo_norm string, num_norm string, dia int, tipo_contrato string"
    values = [v for k, v in BASE.items() if k not in gone]
    spark.createDataFrame([(*values, "NIT", "9", d, "Obra") for d in (5, 20)], kinds).write.parquet(str(tmp_path / "in"))
    past = spark.createDataFrame([("NIT", "9", 10, 1, 0)], "tipo_norm string, num_norm string, dia int, m1 int, m2 int")
    limits = spark.createDataFrame([], "tipo_contrato string, variable string, percentile string, value double")
    got = []
    stream = spark.readStream.schema(kinds).parquet(str(tmp_path / "in"))
    score_stream(stream, past, limits, lambda df, i: got.extend(df.select("dia", "proveedor_sobrecostos_previos").collect()), str(tmp_path / "cp"), once=True).awaitTermination()
    assert sorted(map(tuple, got)) == [(5, 0), (20, 1)]


def test_summary(spark):
    df = spark.createDataFrame([("M1", "auc", None, 0.5), ("M1", "map", 100, 0.25)], "model string, metric string, k int, value double")
    assert "| map@100 | 0.25 |" in markdown_summary(df)

"""Every operator on the driver's tables, with the same result in SQL.

Stand-ins: contract = line item (deduplicated by order and line number), process = order, provider =
supplier, department = nation of the supplier, segment and contract type = part size and type,
modality = order priority, bid = extended price per order, amendment = return flag.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import RuleSet
from .functions import dates, identity, money, scoring, text
from .operators import bids, dedupe, encoding, flags, graph, history, labels, ranking, registry, reshape, thresholds
from .operators.shared import checkpointed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def contracts(spark: SparkSession, d: str, *more: str) -> DataFrame:
    cols = dict.fromkeys(["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_suppkey", "l_partkey", *more])
    rows = table(spark, d, "lineitem").select(*cols)
    return dedupe.keep_first(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_suppkey", "l_partkey"])


#: The deduplicated contracts in SQL.
C = "c AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_extendedprice, l_suppkey, l_partkey) AS rn FROM lineitem) WHERE rn = 1)"


# --- scans, projections, scalar functions ---


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 1000 AND l_shipdate >= DATE '1999-01-01'")
def scan_project_filter(spark, d):
    df = table(spark, d, "lineitem").filter((F.col("l_extendedprice") > 1000) & (F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")))
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN try_cast(replace(replace('$' || (o_orderkey // 1000)::VARCHAR || ',' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') || '.50', '$', ''), ',', '') AS DOUBLE) END AS value FROM orders")
def clean_currency(spark, d):
    k = F.col("o_orderkey")
    t = F.concat(F.lit("$"), F.floor(k / 1000).cast("string"), F.lit(","), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".50"))
    return table(spark, d, "orders").select("o_orderkey", money.clean_currency(F.when(k % 17 != 0, t).otherwise("n/a")).alias("value"))


@query("SELECT c_custkey, num, CASE WHEN num = '' THEN 'empty' WHEN regexp_full_match(num, '0+') THEN 'all_zeros' WHEN length(num) < 3 THEN 'too_short' END AS reason, (length(num) < 3 OR regexp_full_match(num, '0+')) AS malformed FROM (SELECT c_custkey, regexp_replace(CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN '1-2' ELSE c_name || '-' || (c_custkey % 10) END, '[^0-9]', '', 'g') AS num FROM customer)")
def normalize_doc_number(spark, d):
    k = F.col("c_custkey")
    raw = F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 11 == 0, "1-2").otherwise(F.concat("c_name", F.lit("-"), (k % 10).cast("string")))
    num = identity.normalize_number(raw)
    return table(spark, d, "customer").select("c_custkey", num.alias("num")).select("c_custkey", "num", identity.reject_reason(F.col("num")).alias("reason"), identity.is_malformed(F.col("num")).alias("malformed"))


@query("SELECT doc_id, strip_accents(text) AS plain FROM documents")
def strip_accents_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.strip_accents(F.col("text")).alias("plain"))


@query("SELECT c_custkey, CASE WHEN t IN ('CC', 'NIT', 'PASAPORTE') THEN t WHEN t LIKE '%CEDULA DE CIUDADANIA%' THEN 'CC' WHEN t LIKE '%PERSONA%' AND t LIKE '%JURIDICA%' THEN 'NIT' WHEN t LIKE '%PERSONA%' AND t LIKE '%NATURAL%' THEN 'CC' WHEN t LIKE '%CEDULA%' AND t LIKE '%EXTRANJERIA%' THEN 'CE' ELSE 'OTRO' END AS tipo FROM (SELECT c_custkey, strip_accents(upper(trim(CASE c_custkey % 8 WHEN 0 THEN ' cédula de ciudadanía' WHEN 1 THEN 'nit' WHEN 2 THEN 'Persona Jurídica' WHEN 3 THEN 'persona natural' WHEN 4 THEN 'Cédula de Extranjería' WHEN 5 THEN 'CE' WHEN 6 THEN 'pasaporte ' ELSE c_mktsegment END))) AS t FROM customer)")
def normalize_doc_type(spark, d):
    k = F.col("c_custkey") % 8
    raw = F.when(k == 0, " cédula de ciudadanía").when(k == 1, "nit").when(k == 2, "Persona Jurídica").when(k == 3, "persona natural").when(k == 4, "Cédula de Extranjería").when(k == 5, "CE").when(k == 6, "pasaporte ").otherwise(F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", identity.normalize_type(raw).alias("tipo"))


@query(r"SELECT p_partkey, CASE WHEN regexp_matches(upper(n), 'LTDA|SAS|S\.A\.S|S\.A\.|COOPERATIVA|FUNDACION|CORPORACION|ASOCIACION|UNION TEMPORAL|CONSORCIO|E\.S\.P|E\.S\.E|E\.I\.C\.E|SOCIEDAD') OR length(num) >= 9 THEN 'NIT' ELSE 'CC' END AS tipo FROM (SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN ' s.a.s' WHEN 1 THEN ' Ltda' ELSE '' END AS n, CASE WHEN p_partkey % 3 = 0 THEN '900123456' ELSE p_partkey::VARCHAR END AS num FROM part)")
def infer_doc_type(spark, d):
    k = F.col("p_partkey")
    name = F.concat("p_name", F.when(k % 4 == 0, " s.a.s").when(k % 4 == 1, " Ltda").otherwise(""))
    num = F.when(k % 3 == 0, "900123456").otherwise(k.cast("string"))
    return table(spark, d, "part").select("p_partkey", identity.infer_type(name, num).alias("tipo"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN o_orderdate::DATE::VARCHAR END AS day, CASE WHEN o_orderkey % 5 <> 4 THEN o_orderdate::DATE::VARCHAR END AS registered FROM orders")
def parse_dates_mixed(spark, d):
    k, day = F.col("o_orderkey") % 5, F.col("o_orderdate")
    raw = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00"))).when(k.isin(2, 3), F.date_format(day, "MM/dd/yyyy")).otherwise("31-12-x")
    return table(spark, d, "orders").select("o_orderkey", dates.parse_date(raw).cast("string").alias("day"), dates.parse_registration_date(raw).cast("string").alias("registered"))


@query("SELECT l_orderkey, l_linenumber, CASE (l_orderkey % 6)::INT WHEN 0 THEN q * 1.0 WHEN 1 THEN q * 30.0 WHEN 2 THEN q * 365.0 WHEN 3 THEN q * 7.0 WHEN 4 THEN round_even(q / 24.0, 0) END::DOUBLE AS days FROM (SELECT l_orderkey, l_linenumber, l_quantity::INT AS q FROM (WITH " + C + " SELECT * FROM c))")
def parse_duration(spark, d):
    k = (F.col("l_orderkey") % 6).cast("int")
    unit = F.element_at(F.array(*map(F.lit, ("Dia(s)", "mes(es)", "Año(s)", "Semana(s)", "Hora(s)", "No definido"))), k + 1)
    raw = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" "), unit)
    return contracts(spark, d, "l_quantity").select("l_orderkey", "l_linenumber", dates.parse_duration(raw).alias("days"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size END::DOUBLE AS segment FROM (SELECT p_partkey, (lpad(p_size::VARCHAR, 2, '0'))::INT AS p_size FROM part)")
def segment_code(spark, d):
    code = F.when(F.col("p_partkey") % 9 == 0, "V1.x").otherwise(F.concat(F.when(F.col("p_partkey") % 2 == 0, "v1.").otherwise(" V1."), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("111600")))
    return table(spark, d, "part").select("p_partkey", text.unspsc_segment(code).cast("double").alias("segment"))


_MODALITY = "CASE (o_orderkey % 5)::INT WHEN 0 THEN 'Contratación Directa' WHEN 1 THEN 'Contratación régimen especial (con ofertas)' WHEN 2 THEN 'Licitación pública' WHEN 3 THEN o_orderpriority END"


def _modality():
    k = (F.col("o_orderkey") % 5).cast("int")
    return F.when(k == 0, "Contratación Directa").when(k == 1, "Contratación régimen especial (con ofertas)").when(k == 2, "Licitación pública").when(k == 3, F.col("o_orderpriority"))


@query(
    "SELECT o_orderkey, (m LIKE '%contrataci%' AND m LIKE '%directa%')::INT AS direct, (m LIKE '%r%' AND m LIKE '%gimen especial%')::INT AS special, (m IN ('', 'n/a', 'no definido'))::INT = 0 AS justified, (strip_accents(m) IN ('contratacion directa', 'contratacion directa (con ofertas)'))::INT AS exact_direct, (strip_accents(m) IN ('contratacion regimen especial', 'contratacion regimen especial (con ofertas)'))::INT AS exact_special FROM (SELECT o_orderkey, coalesce(lower(trim(" + _MODALITY + ")), '') AS m FROM orders)"
)
def text_flags(spark, d):
    m, r = _modality(), RuleSet()
    return table(spark, d, "orders").select("o_orderkey", text.is_direct_award(m).alias("direct"), text.is_special_regime(m).alias("special"), (text.has_justification(m) == 1).alias("justified"), text.in_modalities(m, r.direct_modalities).alias("exact_direct"), text.in_modalities(m, r.special_modalities).alias("exact_special"))


@query("WITH " + C + " SELECT l_orderkey, l_linenumber, date_diff('day', o_orderdate::DATE, l_shipdate::DATE)::INT AS days, greatest(0, date_diff('day', DATE '1999-01-01', l_shipdate::DATE))::INT AS clamped, month(l_shipdate)::INT AS month, quarter(l_shipdate)::INT AS quarter FROM c JOIN orders ON l_orderkey = o_orderkey")
def day_features(spark, d):
    ship, order = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    df = contracts(spark, d).join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select("l_orderkey", "l_linenumber", dates.days_between(ship, order).alias("days"), dates.days_clamped(ship, F.lit("1999-01-01").cast("date")).alias("clamped"), F.month(ship).alias("month"), F.quarter(ship).alias("quarter"))


_DAYS = ", ".join(f"(DATE '{x}')" for x in ("1996-03-10", "1997-10-26", "1998-05-31", "1998-06-21", "2000-03-12", "2000-10-29", "2002-03-10"))


@query("SELECT o_orderkey, (SELECT min(date_diff('day', o_orderdate::DATE, e)) FROM (VALUES " + _DAYS + ") t(e) WHERE e >= o_orderdate::DATE)::INT AS days FROM orders")
def next_calendar_event(spark, d):
    from datetime import date

    days = tuple(map(date.fromisoformat, ("1996-03-10", "1997-10-26", "1998-05-31", "1998-06-21", "2000-03-12", "2000-10-29", "2002-03-10")))
    return table(spark, d, "orders").select("o_orderkey", dates.days_to_next(F.col("o_orderdate").cast("date"), days).alias("days"))


# --- filters, lookups, set operations ---


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'date' WHEN o_orderkey % 13 = 0 THEN 'value' WHEN o_orderkey % 11 = 0 THEN 'type' END AS reason FROM orders) WHERE reason IS NOT NULL GROUP BY reason")
def required_field_drop_reasons(spark, d):
    k = F.col("o_orderkey")
    blank = {"date": k % 17 == 0, "value": k % 13 == 0, "type": k % 11 == 0}
    return dedupe.drop_counts(table(spark, d, "orders"), dedupe.first_missing(blank))


@query("WITH " + C + " SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice FROM c")
def dedupe_first(spark, d):
    return contracts(spark, d).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")


@query("SELECT l_orderkey, l_suppkey, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_extendedprice DESC, l_suppkey DESC, l_partkey DESC) AS rn FROM lineitem) WHERE rn = 1")
def dedupe_last(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate")
    return dedupe.keep_last(rows, ["l_orderkey"], ["l_shipdate", "l_extendedprice", "l_suppkey", "l_partkey"]).drop("l_shipdate")


@query("SELECT c_custkey, coalesce(n, 0) AS n_orders, coalesce(hi, -1.0) AS highest FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS hi FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON c_custkey = o_custkey")
def left_lookup_defaults(spark, d):
    per = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("highest"))
    return dedupe.lookup(table(spark, d, "customer").select("c_custkey"), per, ["c_custkey"], {"n_orders": 0, "highest": -1.0})


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 17 <> 0 THEN (s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48))::INT END::DOUBLE AS flag FROM supplier")
def semi_flag_nullable(spark, d):
    listed = table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity > 48").select(F.col("l_suppkey").alias("s_suppkey"))
    return dedupe.member_flag(table(spark, d, "supplier").select("s_suppkey"), listed, ["s_suppkey"], "flag", F.col("s_suppkey") % 17 == 0).withColumn("flag", F.col("flag").cast("double"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_orphans(spark, d):
    return dedupe.orphans(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def semi_join(spark, d):
    rich = table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return dedupe.without_orphans(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), rich, ["l_suppkey"])


_REGISTRY_SQL = """
WITH r AS (
  SELECT 'boletines' AS source, CASE WHEN c_custkey % 2 = 0 THEN 'CC' ELSE 'NIT' END AS tipo, regexp_replace(c_name, '[^0-9]', '', 'g') AS num FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'siri', 'CC', regexp_replace('#' || lpad(s_suppkey::VARCHAR, 9, '0'), '[^0-9]', '', 'g') FROM supplier
  UNION ALL SELECT 'resp_fiscales', CASE WHEN length(o_custkey::VARCHAR) >= 9 THEN 'NIT' ELSE 'CC' END, o_custkey::VARCHAR FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'multas_secop', 'NIT', lpad(c_custkey::VARCHAR, 9, '0') FROM customer WHERE c_custkey % 5 = 0
  UNION ALL SELECT 'colusiones', 'NIT', lpad(c_custkey::VARCHAR, 9, '0') FROM customer WHERE c_custkey % 7 = 0)
SELECT tipo AS tipo_documento, num AS numero_documento, bool_or(source = 'boletines') AS en_boletines, bool_or(source = 'siri') AS en_siri, bool_or(source = 'resp_fiscales') AS en_resp_fiscales, bool_or(source = 'multas_secop') AS en_multas_secop, bool_or(source = 'colusiones') AS en_colusiones, false AS en_sanciones_penales, count(DISTINCT source)::INT AS num_fuentes_distintas, false AS malformed
FROM r WHERE length(num) >= 3 AND NOT regexp_full_match(num, '0+') GROUP BY 1, 2
"""


@query(_REGISTRY_SQL)
def registry_union_dedupe(spark, d):
    cust, supp, orders = (table(spark, d, t) for t in ("customer", "supplier", "orders"))
    k = F.col("c_custkey")
    parts = [
        registry.source_rows(cust.filter(k % 3 == 0), "boletines", F.col("c_name"), F.when(k % 2 == 0, "cédula de ciudadanía").otherwise("nit")),
        registry.source_rows(supp, "siri", F.concat(F.lit("#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")), F.lit("persona natural")),
        registry.source_rows(orders.filter("o_orderstatus = 'P'"), "resp_fiscales", F.col("o_custkey"), name=F.lit("x")),
        registry.source_rows(cust.filter(k % 5 == 0), "multas_secop", F.lpad(k.cast("string"), 9, "0"), name=F.lit("Empresa Ltda")),
        registry.source_rows(cust.filter(k % 7 == 0), "colusiones", F.lpad(k.cast("string"), 9, "0"), F.lit("Persona Jurídica")),
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return registry.build_registry(rows)


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN o_custkey = 0 THEN 'all_zeros' ELSE 'too_short' END AS reason FROM orders WHERE length(o_custkey::VARCHAR) < 3 OR o_custkey = 0) GROUP BY reason")
def registry_rejects(spark, d):
    rows = registry.source_rows(table(spark, d, "orders"), "resp_fiscales", F.col("o_custkey"), name=F.lit("x"))
    return registry.rejected_rows(rows).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, coalesce(m1, 0)::INT AS m1, greatest(coalesce(m2, 0), (o_orderkey % 29 = 0)::INT)::INT AS m2 FROM orders LEFT JOIN (SELECT l_orderkey, max((l_returnflag = 'R')::INT) AS m1, max((l_returnflag = 'A')::INT) AS m2 FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1) ON o_orderkey = l_orderkey")
def label_sets_union(spark, d):
    rules = RuleSet(value_amendments=("R",), time_amendments=("A",))
    marks = labels.amendment_flags(table(spark, d, "lineitem").select("l_orderkey", F.lower("l_returnflag").alias("tipo")), rules, "l_orderkey").withColumnRenamed("id_contrato", "o_orderkey")
    out = dedupe.lookup(table(spark, d, "orders").select("o_orderkey"), marks, ["o_orderkey"], {"m1": 0, "m2": 0})
    return out.withColumn("m2", F.greatest("m2", (F.col("o_orderkey") % 29 == 0).cast("int")))


@query("WITH x AS (SELECT (l_returnflag = 'R')::INT AS a, CASE WHEN l_linenumber <> 1 THEN (l_linestatus = 'F')::INT END AS b FROM lineitem) SELECT 'a' AS label, count(*) FILTER (WHERE a = 1) AS positives, count(*) FILTER (WHERE a = 0) AS zeros, count(*) FILTER (WHERE a IS NULL) AS nulls FROM x UNION ALL SELECT 'b', count(*) FILTER (WHERE b = 1), count(*) FILTER (WHERE b = 0), count(*) FILTER (WHERE b IS NULL) FROM x")
def label_distribution(spark, d):
    df = table(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("a"), F.when(F.col("l_linenumber") != 1, (F.col("l_linestatus") == "F").cast("int")).alias("b"))
    return labels.label_counts(df, ("a", "b"))


# --- as-of history ---


def _history_rows(spark, d):
    return contracts(spark, d, "l_returnflag").select("l_orderkey", "l_linenumber", "l_suppkey", dates.day_number(F.col("l_shipdate")).alias("day"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_partkey", F.col("l_shipdate").cast("date").alias("ship"), (F.col("l_returnflag") == "R").cast("int").alias("m1"), (F.col("l_returnflag") == "A").cast("int").alias("m2"))


@query("WITH " + C + ", x AS (SELECT *, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS day FROM c) SELECT l_orderkey, l_linenumber, count(*) OVER w AS n_prior, coalesce(sum(l_extendedprice::DECIMAL(18,2)) OVER w, 0)::DOUBLE AS total, coalesce(sum((l_returnflag = 'R')::INT) OVER w, 0)::BIGINT AS overruns, coalesce(sum((l_returnflag = 'A')::INT) OVER w, 0)::BIGINT AS delays FROM x WINDOW w AS (PARTITION BY l_suppkey ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def asof_history_national(spark, d):
    out = history.attach_history(_history_rows(spark, d), ["l_suppkey"], "day", {"total": "price", "overruns": "m1", "delays": "m2"})
    return out.select("l_orderkey", "l_linenumber", "n_prior", F.col("total").cast("double").alias("total"), "overruns", "delays")


@query("WITH " + C + ", x AS (SELECT c.*, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS dept, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS day FROM c JOIN customer ON c_custkey = l_orderkey % 1000 JOIN nation ON n_nationkey = c_nationkey) SELECT l_orderkey, l_linenumber, CASE WHEN dept IS NULL THEN 0 ELSE count(*) OVER w END AS n_prior, CASE WHEN dept IS NULL THEN 0 ELSE coalesce(sum(l_extendedprice::DECIMAL(18,2)) OVER w, 0) END::DOUBLE AS total FROM x WINDOW w AS (PARTITION BY l_suppkey, dept ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def asof_history_department(spark, d):
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("dept"))
    where = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(nations, "c_nationkey")
    rows = _history_rows(spark, d).withColumn("c_custkey", F.col("l_orderkey") % 1000).join(where, "c_custkey")
    out = history.attach_history(rows, ["l_suppkey", "dept"], "day", {"total": "price"}, valid=F.col("dept").isNotNull())
    return out.select("l_orderkey", "l_linenumber", "n_prior", F.col("total").cast("double").alias("total"))


@query("WITH " + C + " SELECT o_orderkey, count(l_suppkey) AS n_prior, round(coalesce(sum(l_extendedprice::DECIMAL(18,2)), 0)::DOUBLE, 2) AS total FROM orders LEFT JOIN c ON l_suppkey = o_custkey % 100 AND l_shipdate::DATE < o_orderdate::DATE GROUP BY o_orderkey")
def asof_point_probe(spark, d):
    probes = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 100).alias("l_suppkey"), dates.day_number(F.col("o_orderdate")).alias("day"))
    out = history.probe_history(probes, _history_rows(spark, d), ["l_suppkey"], "day", {"total": "price"})
    return out.select("o_orderkey", "n_prior", F.round(F.col("total").cast("double"), 2).alias("total"))


@query("WITH " + C + " SELECT l_suppkey, count(DISTINCT p_size) AS n_segments FROM c JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey")
def distinct_segments(spark, d):
    rows = contracts(spark, d).join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    return history.distinct_segments(rows, ["l_suppkey"], "p_size")


# --- bids, thresholds, encodings ---


@query("WITH x AS (SELECT l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice) AS r FROM lineitem WHERE l_extendedprice > 0) SELECT l_orderkey, CASE WHEN count(*) >= 4 THEN round(kurtosis(l_extendedprice), 6) END AS kurt, CASE WHEN count(*) >= 3 THEN round((max(CASE WHEN r = 2 THEN l_extendedprice END) - min(l_extendedprice)) / min(l_extendedprice), 6) END AS drn, count(*) AS n_bids FROM x GROUP BY l_orderkey")
def bid_stats(spark, d):
    out = bids.bid_stats(table(spark, d, "lineitem"), "l_orderkey", "l_extendedprice")
    return out.select("l_orderkey", F.round("curtosis_licitacion", 6).alias("kurt"), F.round("diferencia_relativa_norm", 6).alias("drn"), "n_bids")


def _measured(spark, d):
    kind = F.when(F.col("p_size") % 7 == 0, F.lit(None).cast("string")).when(F.col("p_partkey") % 50 == 0, F.concat(F.lit("rare"), F.col("p_partkey").cast("string"))).otherwise(F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", kind.alias("kind"), "p_retailprice", F.when(F.col("p_partkey") % 3 != 0, F.col("p_size").cast("double")).alias("size"))


_MEASURED = "m AS (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_partkey % 50 = 0 THEN 'rare' || p_partkey ELSE p_type END AS kind, p_retailprice, CASE WHEN p_partkey % 3 <> 0 THEN p_size::DOUBLE END AS size FROM part), g AS (SELECT m.*, CASE WHEN kind IS NOT NULL AND count(*) OVER (PARTITION BY kind) >= 30 THEN kind ELSE 'Otro' END AS grp FROM m)"
_LONG = "t AS (" + " UNION ALL ".join(f"SELECT grp, '{v}' AS variable, '{p}' AS percentile, quantile_cont({v}, {q}) AS value FROM g GROUP BY grp" for v in ("p_retailprice", "size") for p, q in (("p1", 0.01), ("p5", 0.05), ("p95", 0.95), ("p99", 0.99))) + ")"


@query("WITH " + _MEASURED + ", " + _LONG + " SELECT grp AS kind, variable, percentile, round(value, 6) AS value FROM t WHERE value IS NOT NULL")
def threshold_calibration(spark, d):
    return thresholds.calibrate(_measured(spark, d), "kind", ("p_retailprice", "size")).withColumn("value", F.round("value", 6))


@query("WITH " + _MEASURED + ", " + _LONG + " SELECT m.p_partkey, round(coalesce(a.value, b.value), 6) AS size_p95, 14.0::DOUBLE AS other_p99 FROM m LEFT JOIN t a ON a.grp = m.kind AND a.variable = 'size' AND a.percentile = 'p95' CROSS JOIN (SELECT value FROM t WHERE grp = 'Otro' AND variable = 'size' AND percentile = 'p95') b")
def threshold_fallback(spark, d):
    df = _measured(spark, d)
    long = thresholds.calibrate(df, "kind", ("p_retailprice", "size"))
    out = thresholds.attach_thresholds(df, long, "kind", [("size", "p95"), ("other", "p99")], {("other", "p99"): 14.0})
    return out.select("p_partkey", F.round("size_p95", 6).alias("size_p95"), "other_p99")


_CATEGORY = "CASE WHEN p_size = 1 THEN NULL WHEN p_partkey % 400 = 3 THEN 'rare' || p_partkey ELSE p_brand END"


def _category():
    return F.when(F.col("p_size") == 1, F.lit(None).cast("string")).when(F.col("p_partkey") % 400 == 3, F.concat(F.lit("rare"), F.col("p_partkey").cast("string"))).otherwise(F.col("p_brand"))


_CODES = "k AS (SELECT category, row_number() OVER (ORDER BY category)::INT AS code FROM (SELECT " + _CATEGORY + " AS category, count(*) AS n FROM part GROUP BY 1) WHERE category IS NOT NULL AND n::DOUBLE / (SELECT count(*) FROM part) > 0.001)"


@query("WITH " + _CODES + " SELECT category, code FROM k UNION ALL SELECT 'Other', 0")
def rare_category_encoding(spark, d):
    return encoding.category_codes(table(spark, d, "part").select(_category().alias("c")), "c")


@query("WITH " + _CODES + " SELECT p_partkey, CASE WHEN c IS NOT NULL THEN coalesce(code, 0) END::DOUBLE AS code FROM (SELECT p_partkey, " + _CATEGORY + " AS c FROM part) LEFT JOIN k ON c = category")
def apply_encoding(spark, d):
    df = table(spark, d, "part").select("p_partkey", _category().alias("c"))
    return encoding.encode(df, "c", encoding.category_codes(df, "c"), "code").select("p_partkey", F.col("code").cast("double").alias("code"))


# --- rule index, features, composite score ---


def _flag_inputs(spark, d):
    """Contracts with everything the flags need; an order whose key is divisible by 7 is a missing process."""
    keep = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "day", "ship", "price"]
    rows = checkpointed(_history_rows(spark, d))  # deduplicated once, read for the history, the rows and the segments
    rows = history.attach_history(rows, ["l_suppkey"], "day", {"num_sobrecostos_previos": "m1", "num_retrasos_previos": "m2"}, "num_contratos_previos_nacional")
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("tipo"), "p_size")
    rows = rows.select(*keep, "num_contratos_previos_nacional", "num_sobrecostos_previos", "num_retrasos_previos").join(part, "l_partkey")
    rows = dedupe.lookup(rows, history.distinct_segments(rows.filter("p_size <= 2"), ["l_suppkey"], "p_size", "n_segments"), ["l_suppkey"], {"n_segments": 0})
    orders = table(spark, d, "orders").filter("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("ordered"), "o_orderkey", "o_orderpriority", F.lit(True).alias("has_process"))
    rows = rows.join(orders, "l_orderkey", "left").withColumn("has_process", F.coalesce("has_process", F.lit(False)))
    return rows.withColumns(
        {
            "num_proponentes": F.when(F.col("l_orderkey") % 3 != 0, F.col("l_linenumber")),
            "modalidad": _modality(),
            "dias_publicidad_bruto": F.when(F.col("l_orderkey") % 4 != 0, F.col("l_linenumber") * 4 - 4),
            "dias_decision_bruto": F.datediff("ship", "ordered"),
            "doc_type": F.when(F.col("l_suppkey") % 19 == 0, "No Definido").otherwise("NIT"),
            "doc_number": F.when(F.col("l_suppkey") % 23 == 0, "123").otherwise("900123456"),
            "justificacion": F.when(F.col("l_orderkey") % 10 == 0, " No Especificado").otherwise("x"),
            "valor_contrato": F.col("price").cast("double"),
            "num_contratos_previos_nacional_p95": F.lit(150.0),
            "dias_publicidad_p99": F.lit(14.0),
            "dias_decision_p95": F.lit(43.0),
            "valor_contrato_p99": F.lit(90_000.0),
        }
    )


_FLAG_SQL = (
    "WITH "
    + C
    + ", x AS (SELECT *, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS day FROM c), h AS (SELECT *, count(*) OVER w AS prior, coalesce(sum((l_returnflag = 'R')::INT) OVER w, 0) AS m1, coalesce(sum((l_returnflag = 'A')::INT) OVER w, 0) AS m2 FROM x WINDOW w AS (PARTITION BY l_suppkey ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), sg AS (SELECT l_suppkey, count(DISTINCT p_size) AS seg FROM c JOIN part ON l_partkey = p_partkey WHERE p_size <= 2 GROUP BY 1), o AS (SELECT *, lower(strip_accents("
    + _MODALITY
    + """)) AS m FROM orders WHERE o_orderkey % 7 <> 0), f AS (SELECT h.l_orderkey, h.l_linenumber,
  CASE WHEN o.o_orderkey IS NOT NULL THEN (coalesce(CASE WHEN h.l_orderkey % 3 <> 0 THEN l_linenumber END, 0) <= 1)::INT END AS unico_proponente,
  (coalesce(seg, 0) > 1)::INT AS proveedor_multiproposito, (prior > 150)::INT AS historial_proveedor_alto,
  (coalesce(m, '') IN ('contratacion directa', 'contratacion directa (con ofertas)'))::INT AS contratacion_directa,
  (coalesce(m, '') IN ('contratacion regimen especial', 'contratacion regimen especial (con ofertas)'))::INT AS regimen_especial,
  CASE WHEN o.o_orderkey IS NOT NULL AND h.l_orderkey % 4 <> 0 THEN (l_linenumber * 4 - 4 = 0 OR l_linenumber * 4 - 4 > 14)::INT END AS periodo_publicidad_extremo,
  (h.l_suppkey % 19 = 0 OR h.l_suppkey % 23 = 0 OR h.l_orderkey % 10 = 0 OR l_extendedprice > 90000)::INT AS datos_faltantes,
  CASE WHEN o.o_orderkey IS NOT NULL THEN (l_shipdate::DATE = o_orderdate::DATE OR date_diff('day', o_orderdate::DATE, l_shipdate::DATE) > 43)::INT END AS periodo_decision_extremo,
  (m1 > 0)::INT AS proveedor_sobrecostos_previos, (m2 > 0)::INT AS proveedor_retrasos_previos, (o.o_orderkey IS NULL)::INT AS ausencia_proceso
FROM h LEFT JOIN sg ON sg.l_suppkey = h.l_suppkey LEFT JOIN o ON o.o_orderkey = h.l_orderkey)
"""
)


@query(_FLAG_SQL + "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{n}::DOUBLE AS {n}" for n in flags.FLAGS) + " FROM f")
def rule_flags(spark, d):
    return flags.rule_flags(_flag_inputs(spark, d)).select("l_orderkey", "l_linenumber", *(F.col(n).cast("double").alias(n) for n in flags.FLAGS))


def _sum_sql(names):
    return "(" + " + ".join(f"coalesce({n}, 0)" for n in names) + f") / {float(len(names))}::DOUBLE"


@query(_FLAG_SQL + f"SELECT l_orderkey, l_linenumber, round({_sum_sql(flags.FLAGS)}, 6) AS iric_score, round({_sum_sql(flags.COMPETITION)}, 6) AS iric_competencia, round({_sum_sql(flags.TRANSPARENCY)}, 6) AS iric_transparencia, round({_sum_sql(flags.ANOMALIES)}, 6) AS iric_anomalias FROM f")
def rule_scores(spark, d):
    out = flags.rule_scores(flags.rule_flags(_flag_inputs(spark, d)))
    return out.select("l_orderkey", "l_linenumber", *(F.round(s, 6).alias(s) for s in flags.SCORES))


@query("SELECT o_orderkey, s AS score, CASE WHEN s < 0.2 THEN 'Very Low' WHEN s < 0.4 THEN 'Low' WHEN s < 0.6 THEN 'Medium' WHEN s < 0.8 THEN 'High' ELSE 'Very High' END AS band FROM (SELECT o_orderkey, round_even(0.2 * (o_orderkey % 11) / 10.0 + 0.2 * (o_orderkey % 7) / 7.0 + 0.2 * (o_orderkey % 5) / 5.0 + CASE WHEN o_orderkey % 9 <> 0 THEN 0.2 * (o_orderkey % 3) / 2.0 ELSE 0 END + 0.2 * (o_orderkey % 13) / 13.0, 6)::DOUBLE AS s FROM orders)")
def composite_score_bands(spark, d):
    k = F.col("o_orderkey")
    inputs = {"m1_cost_overruns": k % 11 / 10.0, "m2_delays": k % 7 / 7.0, "m3_comptroller": k % 5 / 5.0, "m4_fines": F.when(k % 9 != 0, k % 3 / 2.0), "iric": k % 13 / 13.0}
    out = table(spark, d, "orders").select("o_orderkey", scoring.composite_score(inputs).alias("score"))
    return out.withColumn("band", scoring.risk_band(F.col("score")))


# --- ranking and calibration ---

_SCORED = "s AS (SELECT o_orderkey AS id, ((o_orderkey * 7919) % 1009) / 1009.0::DOUBLE AS score, (o_orderkey * 31 % 17 < 3 + (o_orderkey * 7919) % 1009 / 200)::INT AS y FROM orders)"


def _scored(spark, d):
    k = F.col("o_orderkey")
    s = (k * 7919) % 1009
    return table(spark, d, "orders").select(k.alias("id"), (s / 1009.0).alias("score"), (k * 31 % 17 < 3 + s / 200).cast("int").alias("y"))


_RANKED = _SCORED + ", r AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank FROM s), q AS (SELECT *, sum(y) OVER (ORDER BY rank) / rank AS p FROM r)"


@query("WITH " + _RANKED + " SELECT k, round(coalesce(avg(p) FILTER (WHERE y = 1 AND rank <= k), 0), 9) AS map FROM q, (VALUES (100), (500), (1000)) t(k) GROUP BY k")
def ranking_map(spark, d):
    return ranking.mean_average_precision(_scored(spark, d), "score", "y", "id").withColumn("map", F.round("map", 9))


@query("WITH " + _RANKED + " SELECT k, round(sum(y) FILTER (WHERE rank <= k) / (SELECT sum(y) FROM s), 9) AS recall, round(sum(y) FILTER (WHERE rank <= k) / least(k, count(*)), 9) AS precision FROM q, (VALUES (10), (50), (100), (500), (1000)) t(k) GROUP BY k")
def ranking_recall_precision(spark, d):
    return ranking.recall_precision(_scored(spark, d), "score", "y", "id").select("k", F.round("recall", 9).alias("recall"), F.round("precision", 9).alias("precision"))


@query("WITH " + _RANKED + ", g AS (SELECT rank, avg(y) OVER (PARTITION BY score) AS gain FROM r), i AS (SELECT row_number() OVER (ORDER BY y DESC) AS rank, y FROM s) SELECT k, round((SELECT sum(gain / log2(rank + 1)) FROM g WHERE rank <= k) / (SELECT sum(y / log2(rank + 1)) FROM i WHERE rank <= k), 9) AS ndcg FROM (VALUES (100), (500), (1000)) t(k)")
def ranking_ndcg(spark, d):
    return ranking.ndcg(_scored(spark, d), "score", "y", "id").withColumn("ndcg", F.round("ndcg", 9))


@query("WITH " + _SCORED + ", r AS (SELECT y, avg(rn) OVER (PARTITION BY score) AS rank FROM (SELECT *, row_number() OVER (ORDER BY score) AS rn FROM s)) SELECT round((sum(rank) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))::DOUBLE, 9) AS auc FROM r")
def auc_rank_sum(spark, d):
    return ranking.auc(_scored(spark, d), "score", "y").withColumn("auc", F.round("auc", 9))


_CURVE = _SCORED + ", b AS (SELECT score, count(*) AS n, sum(y) AS p FROM s GROUP BY score), u AS (SELECT *, sum(n) OVER (ORDER BY score DESC) AS tn, sum(p) OVER (ORDER BY score DESC) AS tp FROM b)"


@query("WITH " + _CURVE + " SELECT round(sum(p * tp / tn::DOUBLE) / sum(p), 9) AS ap FROM u")
def average_precision(spark, d):
    return ranking.average_precision(_scored(spark, d), "score", "y").withColumn("ap", F.round("ap", 9))


@query("WITH " + _CURVE + " SELECT round(score, 9) AS threshold, round((tn - tp) / (SELECT sum(n - p) FROM b)::DOUBLE, 9) AS fpr, round(tp / (SELECT sum(p) FROM b)::DOUBLE, 9) AS tpr FROM u")
def roc_curve(spark, d):
    return ranking.roc_curve(_scored(spark, d), "score", "y").select(*(F.round(c, 9).alias(c) for c in ("threshold", "fpr", "tpr")))


@query("WITH " + _CURVE + " SELECT round(score, 9) AS threshold, round(tp / tn::DOUBLE, 9) AS precision, round(tp / (SELECT sum(p) FROM b)::DOUBLE, 9) AS recall FROM u")
def pr_curve(spark, d):
    return ranking.pr_curve(_scored(spark, d), "score", "y").select(*(F.round(c, 9).alias(c) for c in ("threshold", "precision", "recall")))


_SWEEP = _SCORED + ", t AS (SELECT round(i * 0.05, 2)::DOUBLE AS threshold FROM range(1, 20) r(i)), w AS (SELECT threshold, count(*) FILTER (WHERE score < threshold AND y = 0) AS tn, count(*) FILTER (WHERE score >= threshold AND y = 0) AS fp, count(*) FILTER (WHERE score < threshold AND y = 1) AS fn, count(*) FILTER (WHERE score >= threshold AND y = 1) AS tp FROM s, t GROUP BY threshold), v AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall FROM w), z AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM v)"


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 9) for n in names})


@query("WITH " + _SWEEP + " SELECT threshold, tn, fp, fn, tp, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM z")
def threshold_sweep(spark, d):
    return _rounded(ranking.threshold_sweep(_scored(spark, d), "score", "y"), "precision", "recall", "f1")


@query("WITH " + _SWEEP + " SELECT threshold, tn, fp, fn, tp, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM z ORDER BY round(f1, 12) DESC, threshold LIMIT 1")
def best_threshold(spark, d):
    return _rounded(ranking.best_threshold(ranking.threshold_sweep(_scored(spark, d), "score", "y")), "precision", "recall", "f1")


@query("WITH " + _SCORED + " SELECT round(avg((score - y) * (score - y)), 9) AS brier, round(avg(y) * (1 - avg(y)), 9) AS baseline, round(1 - avg((score - y) * (score - y)) / (avg(y) * (1 - avg(y))), 9) AS skill FROM s")
def calibration(spark, d):
    return _rounded(ranking.calibration(_scored(spark, d), "score", "y"), "brier", "baseline", "skill")


@query("WITH " + _SCORED + " SELECT least(floor(score * 50), 49)::INT AS bin, y AS label, count(*) AS n FROM s GROUP BY ALL")
def score_histogram(spark, d):
    return ranking.score_histogram(_scored(spark, d), "score", "y")


@query("WITH " + _SCORED + " SELECT least(floor(score * 10), 9)::INT AS bin, count(*) AS n, round(avg(score), 9) AS mean_score, round(avg(y), 9) AS share FROM s GROUP BY 1")
def reliability_curve(spark, d):
    return _rounded(ranking.reliability(_scored(spark, d), "score", "y"), "mean_score", "share")


@query("WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY (o_orderkey * 7919) % 1000003, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) SELECT o_orderkey, rn <= round(0.7::DOUBLE * n) AS train FROM r")
def stratified_split(spark, d):
    from .models.split import stratified_split as split

    order = (F.col("o_orderkey") * 7919) % 1_000_003
    return split(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 0.7, [order, F.col("o_orderkey")]).select("o_orderkey", "train")


_ATTR = "a AS (SELECT o_orderkey AS id, 'f' || lpad(i::VARCHAR, 2, '0') AS feature, ((o_orderkey * 37 + i * 101) % 211 - 105) / 105.0::DOUBLE AS value FROM orders, range(0, 14) r(i))"


def _attributions(spark, d):
    i = F.explode(F.sequence(F.lit(0), F.lit(13)))
    df = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), i.alias("i"))
    return df.select("id", F.concat(F.lit("f"), F.lpad(F.col("i").cast("string"), 2, "0")).alias("feature"), (((F.col("id") * 37 + F.col("i") * 101) % 211 - 105) / 105.0).alias("value"))


@query("WITH " + _ATTR + ", r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, feature)::INT AS rank FROM a) SELECT id, feature, round(value, 9) AS value, rank, CASE WHEN value > 0 THEN 'risk_increasing' ELSE 'risk_reducing' END AS direction FROM r WHERE rank <= 10")
def topn_attribution(spark, d):
    out = ranking.top_attributions(_attributions(spark, d), "id", "feature", "value")
    return out.withColumn("direction", scoring.direction(F.col("value"))).withColumn("value", F.round("value", 9))


@query("WITH " + _ATTR + " SELECT feature, round(avg(abs(value)), 6) AS mean_abs FROM a GROUP BY feature ORDER BY mean_abs DESC, feature LIMIT 10")
def global_attribution(spark, d):
    return ranking.global_attributions(_attributions(spark, d), "feature", "value")


@query("WITH a AS (SELECT event_type AS model, 'n' AS metric, count(*)::DOUBLE AS value FROM events WHERE event_id % 2 = 0 AND event_type <> 'error' GROUP BY 1), b AS (SELECT event_type AS model, 'n' AS metric, count(*)::DOUBLE AS value FROM events WHERE event_id % 2 = 1 AND event_type <> 'click' GROUP BY 1) SELECT coalesce(a.model, b.model) AS model, 'n' AS metric, a.value AS v1, b.value AS v2, round(b.value - a.value, 6) AS delta FROM a FULL JOIN b ON a.model = b.model")
def metric_delta(spark, d):
    ev = table(spark, d, "events")
    per = lambda df: df.groupBy(F.col("event_type").alias("model")).agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("metric", F.lit("n"))
    return ranking.metric_delta(per(ev.filter("event_id % 2 = 0 and event_type <> 'error'")), per(ev.filter("event_id % 2 = 1 and event_type <> 'click'")))


# --- reshaping and roll-ups ---

_TYPES = ("click", "error", "purchase", "signup", "view")


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS \"{t}\"" for t in _TYPES) + " FROM events GROUP BY user_id")
def pivot_long_to_wide(spark, d):
    return reshape.pivot_counts(table(spark, d, "events").select("user_id", "event_type"), "user_id", "event_type", _TYPES)


@query("WITH r AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) SELECT user_id, " + ", ".join(f"max(CASE WHEN n = {i} THEN event_type END) AS event_type_{i}, max(CASE WHEN n = {i} THEN value END) AS value_{i}" for i in (1, 2, 3)) + " FROM r GROUP BY user_id")
def flatten_events(spark, d):
    return reshape.flatten_events(table(spark, d, "events"), "user_id", ["event_type", "value"], ["ts", "event_id"], 3)


@query("SELECT date_trunc('month', o_orderdate)::DATE::VARCHAR AS period, count(*) AS n FROM orders GROUP BY 1")
def period_counts(spark, d):
    return reshape.period_counts(table(spark, d, "orders"), "o_orderdate").withColumn("period", F.col("period").cast("string"))


@query("SELECT o_custkey, count(*)::BIGINT AS total, min(o_orderdate)::DATE::VARCHAR AS first_day, max(o_orderdate)::DATE::VARCHAR AS last_day, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1")
def portfolio_rollup(spark, d):
    df = table(spark, d, "orders").select("o_custkey", F.lit(1).alias("one"), F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    return reshape.portfolio_rollup(df, "o_custkey", "one", "day", "o_totalprice").withColumns({"mean_price": F.round("mean_price", 4), "first_day": F.col("first_day").cast("string"), "last_day": F.col("last_day").cast("string")})


@query("SELECT o_custkey, round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE, 2) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS \"n_F\", count(*) FILTER (WHERE o_orderstatus = 'O') AS \"n_O\", count(DISTINCT o_orderpriority) AS distinct_o_orderpriority, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_o_orderpriority FROM orders GROUP BY 1")
def entity_profile(spark, d):
    df = table(spark, d, "orders").withColumn("v", F.col("o_totalprice").cast("decimal(18,2)")).withColumn("ord", F.struct("o_orderdate", "o_orderkey"))
    out = reshape.entity_profile(df, "o_custkey", "v", ("F", "O"), "o_orderstatus", ("o_orderpriority",), "o_orderpriority", "ord")
    return out.withColumn("total", F.round(F.col("total").cast("double"), 2))


@query("SELECT c_nationkey, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 1 ORDER BY mean DESC, c_nationkey LIMIT 5")
def top_entities(spark, d):
    return reshape.top_entities(table(spark, d, "customer"), "c_nationkey", "c_acctbal").withColumn("mean", F.round("mean", 6))


@query("SELECT p_partkey, round(coalesce(v, median(v) OVER (PARTITION BY p_type)), 6) AS v FROM (SELECT p_partkey, p_type, CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS v FROM part)")
def group_median_fill(spark, d):
    df = table(spark, d, "part").select("p_partkey", "p_type", F.when(F.col("p_partkey") % 4 != 0, F.col("p_retailprice")).alias("v"))
    return thresholds.fill_group_median(df, "p_type", "v").select("p_partkey", F.round("v", 6).alias("v"))


@query("SELECT c AS \"column\", q, round(v, 6) AS value FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS c, {q}::DOUBLE AS q, quantile_cont({c}, {q}) AS v FROM orders" for c in ("o_totalprice",) for q in (0.5, 0.95, 0.99, 0.999)) + ")")
def quantile_table(spark, d):
    return thresholds.quantiles(table(spark, d, "orders"), ("o_totalprice",), (0.5, 0.95, 0.99, 0.999)).withColumn("value", F.round("value", 6))


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for i, a in enumerate(("l_quantity", "l_extendedprice", "l_discount")) for b in ("l_quantity", "l_extendedprice", "l_discount")[i:]))
def correlation_matrix(spark, d):
    return thresholds.correlations(table(spark, d, "lineitem"), ("l_quantity", "l_extendedprice", "l_discount")).withColumn("r", F.round("r", 6))


@query("SELECT n_nationkey, '{\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\",\"none\":null}' AS doc FROM nation")
def json_document(spark, d):
    return table(spark, d, "nation").select("n_nationkey", scoring.document(name=F.col("n_name"), key=F.col("n_nationkey"), none=F.lit(None).cast("string")).alias("doc"))


# --- operators that the build uses, each on a table ---


@query("SELECT o_orderkey, day FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN o_orderdate::DATE::VARCHAR END AS day FROM orders) WHERE day IS NOT NULL")
def filter_unparsed_dates(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 5 == 4, "n/a").when(k % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select("o_orderkey", dates.parse_date(raw).cast("string").alias("day")).filter("day is not null")


@query("SELECT c_custkey, trim(c_mktsegment) AS key FROM customer WHERE c_custkey % 6 NOT IN (0, 1, 2)")
def filter_null_keys(spark, d):
    k = F.col("c_custkey") % 6
    raw = F.when(k == 0, " ").when(k == 1, "nan").when(k == 2, "None").otherwise(F.concat(F.lit(" "), F.trim("c_mktsegment"), F.lit("  ")))
    return table(spark, d, "customer").select("c_custkey", text.text_key(raw).alias("key")).filter("key is not null")


@query("SELECT o_orderkey, CASE (o_orderkey % 4)::INT WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey WHEN 2 THEN NULL ELSE 0 END::BIGINT AS n, CASE WHEN o_orderkey % 4 = 3 THEN 1826.0 ELSE 0.0 END::DOUBLE AS days FROM orders")
def parse_counts(spark, d):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.col("o_custkey").cast("string")).when(k == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(".75"))).when(k == 2, "NaN").otherwise("0")
    days = F.when(k == 3, "1,826").otherwise("x")
    return table(spark, d, "orders").select("o_orderkey", money.parse_count(raw).cast("long").alias("n"), money.count_or_zero(days).alias("days"))


@query("SELECT o_orderkey, (length(o_custkey::VARCHAR) >= 3 AND o_custkey % 3 = 0)::INT AS listed, c_name AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0 AND c_custkey > 99) ON c_custkey = o_custkey")
def registry_lookup(spark, d):
    """Identities of contracts looked up in a registry: whether they are listed, and the entry."""
    cust = table(spark, d, "customer").filter("c_custkey % 3 = 0")
    rows = registry.source_rows(cust, "siri", F.col("c_custkey"), F.lit("nit"))
    known = registry.build_registry(rows).join(cust.select(F.col("c_custkey").cast("string").alias("numero_documento"), "c_name"), "numero_documento")
    probes = table(spark, d, "orders").select("o_orderkey", F.lit("NIT").alias("tipo"), F.concat(F.col("o_custkey").cast("string"), F.lit("-")).alias("numero"))
    out = registry.find_identities(known, probes)
    return out.select("o_orderkey", F.coalesce("en_siri", F.lit(False)).cast("int").alias("listed"), F.col("c_name").alias("name"))


@query("SELECT l.l_orderkey, l.l_linenumber, o.o_orderpriority, (o.o_orderkey IS NOT NULL) AS both FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON o.o_orderkey = l.l_orderkey")
def validated_merge(spark, d):
    """A many-to-one merge whose right side is checked for repeated keys, with an indicator."""
    right = dedupe.assert_unique(table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), ["l_orderkey"])
    out = dedupe.lookup(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), right.withColumn("both", F.lit(True)), ["l_orderkey"], {"both": False})
    return out.select("l_orderkey", "l_linenumber", "o_orderpriority", "both")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')")
def resume_rows(spark, d):
    """What a run that was cut off has still to do."""
    done = table(spark, d, "lineitem").filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(F.col("l_orderkey").alias("o_orderkey"))
    return dedupe.resume(table(spark, d, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("SELECT o_custkey, " + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in ("1-URGENT", "2-HIGH", "5-LOW")) + " FROM orders GROUP BY o_custkey")
def indicator_sums(spark, d):
    return encoding.indicator_sums(table(spark, d, "orders"), "o_custkey", "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query("WITH " + _CODES + " SELECT p_partkey, coalesce(category, 'Other') AS category FROM (SELECT p_partkey, " + _CATEGORY + " AS c FROM part) LEFT JOIN k ON c = category WHERE c IS NOT NULL")
def decode_categories(spark, d):
    df = table(spark, d, "part").select("p_partkey", _category().alias("c"))
    codes = encoding.category_codes(df, "c")
    return encoding.decode(encoding.encode(df, "c", codes, "code"), "code", codes, "category").filter("c is not null").select("p_partkey", "category")


@query("SELECT o_orderstatus AS label, count(*) AS n, round(0.7::DOUBLE * count(*))::BIGINT AS train FROM orders GROUP BY 1")
def stratified_split_hashed(spark, d):
    """The split that training takes: by hashes of ids, ranked in two levels; the shares are exact."""
    from .models.split import stratified_split as split

    out = split(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 0.7, id_col="o_orderkey")
    return out.groupBy(F.col("o_orderstatus").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("train"), 1)).alias("train"))


@query("WITH y AS (SELECT l_orderkey, l_linenumber, (l_returnflag = 'R')::INT AS y FROM lineitem) SELECT y AS label, count(*) AS n, round(CASE WHEN y = 1 THEN (SELECT (count(*) - sum(y)) / sum(y)::DOUBLE FROM y) ELSE 1.0 END, 9) AS weight FROM y GROUP BY y")
def class_weights(spark, d):
    from .models import training

    df = training.class_weights(table(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y")), "y")
    return df.groupBy(F.col("y").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 9).alias("weight"))


@query("SELECT y AS label, CASE WHEN y = 1 THEN floor(0.25::DOUBLE / 0.75 * (SELECT count(*) FROM lineitem WHERE l_linenumber <> 7)) ELSE count(*) END::BIGINT AS n, count(*) AS distinct_ids_at_most FROM (SELECT (l_linenumber = 7)::INT AS y FROM lineitem) GROUP BY y")
def upsample(spark, d):
    """The minority with replacement up to a fourth of all rows: exact counts."""
    from .models.split import upsample as up

    df = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_linenumber") == 7).cast("int").alias("y"))
    sizes = df.groupBy("y").agg(F.count(F.lit(1)).alias("distinct_ids_at_most"))
    return up(df, "y").groupBy("y").agg(F.count(F.lit(1)).alias("n")).join(sizes, "y").select(F.col("y").alias("label"), "n", "distinct_ids_at_most")


@query("SELECT o_orderstatus AS label, count(*) AS n, 5::BIGINT AS folds FROM orders GROUP BY 1")
def stratified_folds(spark, d):
    from .models.split import folds

    out = folds(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 5, "o_orderkey")
    return out.groupBy(F.col("o_orderstatus").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("fold").alias("folds"))


# --- graph ---


@query("SELECT source, via, target FROM (SELECT DISTINCT o_custkey AS source, o_orderkey AS via FROM orders) JOIN (SELECT DISTINCT l_orderkey AS via, l_suppkey AS target FROM lineitem) USING (via)")
def graph_two_hops(spark, d):
    first = table(spark, d, "orders").select(F.col("o_custkey").alias("source"), F.col("o_orderkey").alias("target"))
    second = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source"), F.col("l_suppkey").alias("target"))
    return graph.two_hops(first, second)


@query("SELECT o_custkey, round(sum(v * v) / (sum(v) * sum(v)), 6) AS hhi, count(*) AS n_members FROM (SELECT o_custkey, o_orderpriority, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2) GROUP BY 1")
def graph_concentration(spark, d):
    return graph.concentration(table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_totalprice").withColumn("hhi", F.round("hhi", 6))


@query("SELECT p_partkey, round(p_retailprice / median(p_retailprice) OVER (PARTITION BY p_type), 6) AS ratio FROM part")
def graph_ratio_to_median(spark, d):
    return graph.ratio_to_median(table(spark, d, "part"), "p_type", "p_retailprice").select("p_partkey", F.round("ratio", 6).alias("ratio"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 0 OR l_shipdate::DATE <= DATE '1999-06-30'")
def graph_edges_asof(spark, d):
    day = F.when(F.col("l_orderkey") % 3 != 0, F.col("l_shipdate").cast("date"))
    return graph.edges_asof(table(spark, d, "lineitem"), day, F.lit("1999-06-30").cast("date")).select("l_orderkey", "l_linenumber")


@query("SELECT 'supplier' AS kind, s_suppkey::VARCHAR AS id FROM supplier UNION ALL SELECT 'customer', c_custkey::VARCHAR FROM customer UNION ALL SELECT 'order', o_orderkey::VARCHAR FROM orders")
def graph_nodes(spark, d):
    return graph.nodes_of({"supplier": (table(spark, d, "supplier"), "s_suppkey"), "customer": (table(spark, d, "customer"), "c_custkey"), "order": (table(spark, d, "orders"), "o_orderkey")})


@query("SELECT n_regionkey AS component, count(*) AS size, round(sum(c_acctbal::DECIMAL(18,2))::DOUBLE, 2) AS total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def graph_community_features(spark, d):
    members = table(spark, d, "customer").join(table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey").select(F.col("c_custkey").alias("node"), F.col("n_regionkey").alias("component"))
    values = table(spark, d, "customer").select(F.col("c_custkey").alias("node"), F.col("c_acctbal").cast("decimal(18,2)").alias("v"))
    return graph.community_features(members, values, "v").withColumn("total", F.round(F.col("total").cast("double"), 2))


@query()
def graph_components(spark, d):
    """Too slow as a recursive query on whole tables; tests hold it against brute force."""
    k = F.col("p_partkey")
    edges = table(spark, d, "part").select(F.concat("p_brand", F.lit("/"), (k % 7).cast("string")).alias("source"), F.concat("p_type", F.lit("/"), (F.floor(k / 8) % 9).cast("string")).alias("target"))
    return graph.components(edges)


@query()
def graph_name_match(spark, d):
    left = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Proveedór "), F.col("s_name")).alias("name"))
    right = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("PROVEEDOR - Supplier "), F.substring("c_name", 9, 20)).alias("name"))
    return graph.ngram_match(left, right, "s_suppkey", "name", "c_custkey", "name")


@query()
def graph_ego_network(spark, d):
    edges = table(spark, d, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("source"), F.concat(F.lit("o"), "l_orderkey").alias("target"), "l_extendedprice")
    return graph.ego_network(edges, "s1", 2, 20, "l_extendedprice")


@query()
def train_score_gbt(spark, d):
    """Split, weight, fit, score and evaluate boosted trees that predict returned line items."""
    from .models import training

    df = contracts(spark, d, "l_returnflag", "l_quantity", "l_discount", "l_tax").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_quantity", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_extendedprice")).alias("price"), "l_discount", "l_tax", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    model = training.train(df, "id", "y", ["l_quantity", "price", "l_discount", "l_tax"], training.TrainConfig(candidates=({"maxIter": 3, "maxDepth": 3},), folds=2))
    return ranking.auc(model.score(model.test), "score", "y")


@query()
def treeshap(spark, d):
    from .models import attribution, training

    df = contracts(spark, d, "l_returnflag", "l_quantity", "l_discount").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_quantity", "l_extendedprice", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    model = training.fit_model(df, "y", names, {"maxIter": 3, "maxDepth": 3})
    return attribution.explain(model, df, "id", names)

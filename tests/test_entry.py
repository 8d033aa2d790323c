import __spark_entry__ as entry
from veedor import queries


def test_every_query_is_registered(spark):
    found = entry.queries()
    assert set(queries.QUERIES) <= set(found)
    assert set(entry.oracle_sql()) <= set(found)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "n_prior", "total", "overruns", "delays"]
    assert df.count() > 0


def test_oracles_agree_on_the_smallest_tables(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    for name in ("asof_history_national", "bid_stats", "rule_scores", "threshold_calibration", "ranking_ndcg", "registry_union_dedupe", "upsample", "validated_merge", "decode_categories"):
        got = queries.QUERIES[name](spark, d)
        cols = sorted(got.columns)
        plain = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
        a = sorted(tuple(map(plain, r)) for r in got.select(*cols).collect())
        want = con.sql(queries.ORACLE[name])
        at = [want.columns.index(c) for c in cols]
        b = sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
        assert a == b, name

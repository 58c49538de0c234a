import __spark_entry__ as entry
from transit_prices.checks.compare import duck_connect, table_digest

SF = "/root/testdata/sf0.001"
QUICK = ["commune_year_prices", "clean_sales", "nearest_station", "station_city_codes", "did_by_group",
         "station_month_features", "chrono_split", "sequences_multi", "dml_linear"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "ate_pct" in df.columns


def test_registry_contract():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_quick_oracles(spark):
    con = duck_connect(SF)
    qs, sqls = entry.queries(), entry.oracle_sql()
    for name in QUICK:
        df = qs[name](spark, SF)
        s = table_digest(df.columns, [tuple(r) for r in df.collect()])
        cur = con.execute(sqls[name])
        d = table_digest([c[0] for c in cur.description], cur.fetchall())
        assert s[:3] == d[:3], name

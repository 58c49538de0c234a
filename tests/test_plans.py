from transit_prices.plans import causal
from transit_prices.operators import enrich

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rates_join_is_broadcast(spark):
    inp = causal.load_inputs(spark, SF)
    plan = _plan(enrich.join_rates_month(inp.sales, inp.rates))
    assert "BroadcastHashJoin" in plan


def test_enriched_scans_are_pruned(spark):
    inp = causal.load_inputs(spark, SF)
    e = causal.enriched_sales(inp).select("sale_id", "distance_gp_km")
    text = e._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # lineitem is read with only the needed columns (no comment/tax columns)
    assert "l_tax" not in text and "l_comment" not in text


def test_lineitem_moves_once_in_the_sales_join(spark, monkeypatch):
    from transit_prices.sources import adapters

    monkeypatch.setattr(adapters, "FEW_ORDERS", 0)
    key, limit = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        plan = _plan(adapters.sales_base(spark, SF).select("l_suppkey"))
    finally:
        spark.conf.set(key, limit)
    # outer exchanges are printed first: customers meet orders below lineitem's join
    assert plan.index("hashpartitioning(l_orderkey") < plan.index("hashpartitioning(o_custkey")


def test_complete_panels_do_not_read_the_sales_again(spark):
    from pyspark.sql import functions as F

    from transit_prices.operators import panel

    sales = spark.range(120).select((F.col("id") % 3).alias("station"), F.expr("make_date(2000, 1 + cast(id % 4 as int), 5)").alias("date"),
                                    F.col("id").cast("double").alias("p"), F.lit("a").alias("kind"))
    sales = sales.where("not (station = 2 and month(date) = 4)")
    for found in (panel.station_month_features(sales, "date", "station", ["p"], shares={"share_a": ("kind", "a")}),
                  panel.station_month_features_mode(sales, "date", "station", ["p"], ["kind"])):
        assert "Range (" not in _plan(found)
        assert sorted({r["station"] for r in found.collect()}) == [0, 1] and found.count() == 8


def test_mapping_of_few_categories_is_broadcast(spark):
    from transit_prices.operators import features

    key, limit = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("z", 4)], "k string, i int")
    mapping = features.fit_ordinal(df.where("i < 4"), "k")
    spark.conf.set(key, "-1")
    try:
        out = features.apply_ordinal(df, mapping, "k")
        assert "SortMergeJoin" not in _plan(out)
    finally:
        spark.conf.set(key, limit)
    assert sorted((r["i"], r["k"]) for r in out.collect()) == [(1, 0.0), (2, -1.0), (3, 1.0), (4, -1.0)]

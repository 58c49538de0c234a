"""Domain tables derived from the driver's TPC-H-like tables.

The driver data holds no housing records, so each domain feed is derived by
fixed formulas (see FIXTURES.md §3) that DuckDB evaluates identically; the
oracle SQL in ``transit_prices.checks.oracle_sql`` repeats them. Every table
is a lazy projection/join/aggregate of the given tables, so its size grows
with the scale factor.

Fixed derivation constants (shared with the oracle):
  sale lat  = 48.6 + ((o_custkey*37) % 1000) / 2000
  sale lon  = 2.0  + ((o_custkey*91) % 1000) / 1250
  station lat (milli-degrees) = 48600 + 5 * ((s_suppkey*53) % 100)
  station lon (milli-degrees) = 2000  + 8 * ((s_suppkey*29) % 100)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import ensure_parallelism, read_table

#: Up to so many orders, the sales are joined from the left.
FEW_ORDERS = 200_000

NATURE_VEFA = "Vente en l'état futur d'achèvement"


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


def _num_text(c):
    """Double -> text with a decimal comma (the feed's number format)."""
    return F.replace(c.cast("string"), F.lit("."), F.lit(","))


def _milli_text(milli):
    """Exact decimal text of an integer number of thousandths, e.g. 48635 -> '48.635'."""
    return F.concat(
        F.floor(milli / 1000).cast("string"),
        F.lit("."),
        F.lpad((milli % 1000).cast("string"), 3, "0"),
    )


def sales_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation, only the columns the domain needs."""
    li = ensure_parallelism(_t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
    ))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    of_order, of_customer, of_nation = li.l_orderkey == o.o_orderkey, F.col("o_custkey") == F.col("c_custkey"), F.col("c_nationkey") == F.col("n_nationkey")
    if o.count() <= FEW_ORDERS:  # broadcast by the planner: lineitem stays where it is
        df = li.join(o, of_order).join(c, of_customer).join(n, of_nation)
    else:  # orders meet their customers first, so that the wide and long lineitem moves once
        df = li.join(o.join(c, of_customer).join(n, of_nation), of_order)
    ship = F.to_date("l_shipdate")
    # the 7-column sale key (l_orderkey, l_linenumber alone is not unique),
    # written with integers only so that its text is engine-independent
    sale_id = F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round("l_quantity").cast("bigint"), F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        ship.cast("string"),
    )
    return df.select(
        sale_id.alias("sale_id"),
        ship.alias("ship_date"),
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "o_custkey", "n_nationkey", "n_regionkey", "n_name",
    )


def _nature(linenumber, linestatus):
    return (
        F.when(linenumber == 5, F.lit("Echange"))
        .when(linestatus == "F", F.lit("Vente"))
        .otherwise(F.lit(NATURE_VEFA))
    )


def _type_local(flag):
    return F.when(flag == "A", "Appartement").when(flag == "R", "Maison").otherwise("Local")


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transaction feed, all text, as a CSV read would give it (after the
    header mapping): day-first dates, decimal commas, numbered streets."""
    b = sales_base(spark, sf_dir)
    return b.select(
        "sale_id",
        F.col("l_orderkey").alias("order_key"),
        F.date_format("ship_date", "dd/MM/yyyy").alias("date_mutation"),
        _nature(F.col("l_linenumber"), F.col("l_linestatus")).alias("nature_mutation"),
        _type_local(F.col("l_returnflag")).alias("type_local"),
        F.col("l_linenumber").cast("string").alias("rooms"),
        _num_text(F.col("l_quantity") * 4).alias("surface"),
        _num_text(F.round(F.col("l_extendedprice") * 10, 2)).alias("valeur_fonciere"),
        F.floor(F.col("o_custkey") / 4).cast("string").alias("no_voie"),
        F.when(F.col("o_custkey") % 2 == 0, "AV").otherwise("RUE").alias("type_voie"),
        F.col("n_name").alias("voie"),
        (F.lit(75000) + F.col("n_nationkey")).cast("string").alias("code_postal"),
        F.col("n_name").alias("commune"),
        F.col("n_regionkey").cast("string").alias("code_departement"),
        F.col("n_nationkey").cast("string").alias("code_commune"),
    )


def sales_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sales grouped by supplier instead of nearest station: the
    station x month panel source for F3-F7 and the sequence/forecast work
    (83 months; 61 of 100 suppliers complete at sf0.01)."""
    b = sales_base(spark, sf_dir)
    surface = F.col("l_quantity") * 4
    value = F.round(F.col("l_extendedprice") * 10, 2)
    return b.select(
        "sale_id",
        F.col("l_suppkey").alias("station"),
        F.col("ship_date").alias("date"),
        _nature(F.col("l_linenumber"), F.col("l_linestatus")).alias("nature_mutation"),
        _type_local(F.col("l_returnflag")).alias("type_local"),
        F.col("l_linenumber").cast("double").alias("rooms"),
        surface.alias("surface"),
        value.alias("valeur_fonciere"),
        (value / surface).alias("prix_m2"),
        F.col("l_discount").alias("discount"),
    )


def register_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address register: one row per customer; two of four neighbouring
    customers share an address if they live in one nation, so a key holds one or
    two points at any scale."""
    c = ensure_parallelism(_t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return df.select(
        F.floor(F.col("c_custkey") / 4).cast("string").alias("numero"),
        F.concat(F.when(F.col("c_custkey") % 2 == 0, "AVENUE ").otherwise("RUE "), F.col("n_name")).alias("nom_voie"),
        (F.lit(75000) + F.col("n_nationkey")).cast("string").alias("code_postal"),
        F.col("n_name").alias("nom_commune"),
        (F.lit(2.0) + ((F.col("c_custkey") * 91) % 1000) / F.lit(1250.0)).alias("lon"),
        (F.lit(48.6) + ((F.col("c_custkey") * 37) % 1000) / F.lit(2000.0)).alias("lat"),
    )


def _station_points(df):
    k = F.col("s_suppkey")
    lat_milli = F.lit(48600) + F.lit(5) * ((k * 53) % 100)
    lon_milli = F.lit(2000) + F.lit(8) * ((k * 29) % 100)
    return F.concat(_milli_text(lat_milli), F.lit(", "), _milli_text(lon_milli))


def new_stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New-station feed (even supplier keys), text columns as in the CSV."""
    s = _t(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 2 == 0)
    k = F.col("s_suppkey")
    sig_year = F.lit(1996) + k % 4
    return s.select(
        F.when(k % 23 == 0, F.lit("48.7")).otherwise(_station_points(s)).alias("geo_point"),
        F.col("s_name").alias("nom_gare"),
        F.when(k % 3 == 0, " Interconnexion ").when(k % 3 == 1, "Non").otherwise("?").alias("interconnexion"),
        F.concat(F.lit("L "), (F.col("s_nationkey") % 5 + 14).cast("string")).alias("lignes"),
        F.when(k % 17 == 0, F.lit("inconnue"))
        .otherwise(F.concat(sig_year.cast("string"), F.lit("-01-01"))).alias("date_signature"),
        F.concat(F.lit("01/01/"), (sig_year + 2).cast("string")).alias("date_ouverture"),
    )


# Transport modes of the existing-station feed, indexed by nation % 5.
EXISTING_MODES = ["METRO", "RER", "Tramway", "VAL", None]


def existing_stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing-station feed (odd supplier keys)."""
    s = _t(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 2 == 1)
    k = F.col("s_suppkey")
    m = F.col("s_nationkey") % 5
    mode = F.when(m == 0, "METRO").when(m == 1, "RER").when(m == 2, "Tramway").when(m == 3, "VAL") \
        .otherwise(F.lit(None).cast("string"))
    return s.select(
        k.alias("gares_id"),
        F.col("s_name").alias("nom_iv"),
        _station_points(s).alias("geo_point"),
        mode.alias("mode"),
        F.when(k % 7 == 0, 0).otherwise(1).alias("idf"),
        F.concat(F.lit("RES_"), F.col("s_nationkey").cast("string")).alias("res_com"),
        F.lit("operator").alias("exploitant"),
        F.col("s_acctbal").alias("x"),
        F.col("s_nationkey").alias("y"),
    )


def rates_daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate feed form a: one row per order date, several per month."""
    o = _t(spark, sf_dir, "orders")
    return (
        o.groupBy(F.to_date("o_orderdate").alias("day"))
        .agg((F.avg("o_totalprice") / F.lit(100000.0)).alias("taux"))
        .select(F.col("day").cast("string").alias("date"), "taux")
    )


def rates_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate feed form b: (annee, mois, taux, variation_mom, variation_yoy).
    The changes come from self-joins on calendar months (a missing month
    gives null), not from a global single-partition window."""
    o = _t(spark, sf_dir, "orders")
    m = o.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(
        (F.avg("o_totalprice") / F.lit(100000.0)).alias("taux")
    )
    p1 = m.select(F.add_months("month", 1).alias("month"), F.col("taux").alias("taux_m1"))
    p12 = m.select(F.add_months("month", 12).alias("month"), F.col("taux").alias("taux_m12"))
    out = m.join(p1, "month", "left").join(p12, "month", "left")
    return out.select(
        F.year("month").alias("annee"),
        F.month("month").alias("mois"),
        "taux",
        (F.col("taux") - F.col("taux_m1")).alias("variation_mom"),
        (F.col("taux") - F.col("taux_m12")).alias("variation_yoy"),
    )


def indicators_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commune indicators from customers by nation. Nations with key % 6 = 0
    get a second, later row (different values) so that de-duplication on the
    code is exercised; ``src_row`` is the file order."""
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")

    def block(df, src_row):
        seg = F.col("c_mktsegment")
        agg = df.groupBy("c_nationkey").agg(
            F.avg("c_acctbal").alias("revenu_median_2021"),
            (F.count(F.lit(1)) / F.lit(100.0)).alias("evo_population_2016_2022"),
            F.avg((seg == "BUILDING").cast("double")).alias("part_proprio_2022"),
            F.avg((seg == "AUTOMOBILE").cast("double")).alias("part_hlm_2022"),
            F.avg((seg == "MACHINERY").cast("double")).alias("part_cadres_2022"),
            F.avg((seg == "HOUSEHOLD").cast("double")).alias("part_log_vacants_2022"),
            F.avg((seg == "FURNITURE").cast("double")).alias("taux_chomage_2024"),
            F.avg((F.col("c_acctbal") < 0).cast("double")).alias("part_eleves_prive_2024"),
            F.count(F.lit(1)).cast("double").alias("nb_etablissements_2023"),
        )
        return agg.withColumn("src_row", F.lit(src_row))

    both = block(c, 0).unionByName(block(c.where(F.col("c_acctbal") > 0), 1))
    both = both.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    both = both.where((F.col("src_row") == 0) | (F.col("n_nationkey") % 6 == 0))
    dept = F.lpad(F.col("n_regionkey").cast("string"), 2, "0")
    ville = F.when(F.col("n_nationkey") % 3 == 0, F.replace("n_name", F.lit("NATION"), F.lit("Nätion"))) \
        .otherwise(F.col("n_name"))
    return both.select(
        F.concat(dept, F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("code_ville"),
        dept.alias("departement"),
        ville.alias("ville"),
        "revenu_median_2021", "evo_population_2016_2022", "part_proprio_2022", "part_hlm_2022",
        "part_cadres_2022", "part_log_vacants_2022", "taux_chomage_2024", "part_eleves_prive_2024",
        "nb_etablissements_2023", "src_row",
    )


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commune code list (code padded to 5, name)."""
    n = _t(spark, sf_dir, "nation").where(F.col("n_nationkey") % 5 != 0)
    return n.select(
        F.concat(F.lpad(F.col("n_regionkey").cast("string"), 2, "0"),
                 F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("code_insee"),
        F.lower("n_name").alias("commune"),
    )

import unicodedata

from pyspark.sql import functions as F

from transit_prices.functions import text as tx


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_fr_number(spark):
    assert one(spark, tx.parse_fr_number("v"), "250 000,50") == 250000.5
    assert one(spark, tx.parse_fr_number("v"), "") is None
    assert one(spark, tx.parse_fr_number("v"), "abc") is None
    assert one(spark, tx.parse_fr_number("v"), None) is None
    assert one(spark, tx.parse_fr_number("v"), "NaN") is None


def test_dates(spark):
    import datetime as dt

    assert one(spark, tx.parse_date_strict("v"), "01/02/2020") == dt.date(2020, 2, 1)
    assert one(spark, tx.parse_date_strict("v"), "1/2/2020") == dt.date(2020, 2, 1)
    assert one(spark, tx.parse_date_strict("v"), "2020-02-01") is None
    assert one(spark, tx.parse_date_lenient("v"), "2020-02-01") == dt.date(2020, 2, 1)
    assert one(spark, tx.parse_date_lenient("v"), "01/02/2020") == dt.date(2020, 2, 1)
    assert one(spark, tx.parse_date_lenient("v"), "inconnue") is None


def test_split_lat_lon(spark):
    df = spark.createDataFrame([("48.81, 2.27",), ("48.81",), ("x,y",), (None,), ("1,2,3",)], "g string")
    lat, lon = tx.split_lat_lon("g")
    rows = df.select(lat.alias("a"), lon.alias("o")).collect()
    assert (rows[0]["a"], rows[0]["o"]) == (48.81, 2.27)
    assert all(r["a"] is None and r["o"] is None for r in rows[1:])


def test_small_rules(spark):
    assert one(spark, tx.yes_no("v"), " Interconnexion ") == "oui"
    assert one(spark, tx.yes_no("v"), "Non") == "non"
    assert one(spark, tx.yes_no("v"), "?") is None
    assert one(spark, tx.zero_pad("v", 3), "7") == "007"
    assert one(spark, tx.zero_pad("v", 3), "12345") == "12345"      # never truncated
    assert one(spark, tx.paris_commune_code(F.lit("paris 12"), F.col("v")), "112") == "056"
    assert one(spark, tx.paris_commune_code(F.lit("paris"), F.col("v")), "112") == "112"
    assert one(spark, tx.remove_spaces("v"), "L 15 ") == "L15"
    assert one(spark, tx.expand_street_type("v"), "AV") == "AVENUE"
    assert one(spark, tx.expand_street_type("v"), "XYZ") == "XYZ"
    assert one(spark, tx.strip_dot_zero("v"), "12.0") == "12"
    assert one(spark, tx.strip_dot_zero("v"), None) == ""
    assert one(spark, tx.postcode5("v"), "75012.0") == "75012"
    assert one(spark, tx.department_from_postcode("v"), "75012") == "75"
    assert one(spark, tx.department_from_postcode("v"), "7") is None


def _py_fold(s, strip_first=True):
    s = s.upper()
    if strip_first:
        s = s.strip()
    s = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")
    return s if strip_first else s.strip()


def test_fold_matches_python_rule(spark):
    words = [" Évry ", "œuvre", "Straße", "Ñandú", "Göteborg", "ÇA", "plain", "ĳssel", "Ÿ", "ǅ"]
    df = spark.createDataFrame([(w,) for w in words], "v string")
    got = [r[0] for r in df.select(tx.fold_accents("v")).collect()]
    assert got == [_py_fold(w) for w in words]
    got2 = [r[0] for r in df.select(tx.fold_accents("v", strip_first=False, null_as_empty=False)).collect()]
    assert got2 == [_py_fold(w, False) for w in words]
    exact = [r[0] for r in df.select(tx.fold_accents_exact("v")).collect()]
    assert exact == [_py_fold(w) for w in words]


def test_address_key(spark):
    df = spark.createDataFrame([("12.0", "AV", "Évry", "91000.0"), (None, None, "X", "75011")],
                               "n string, t string, v string, p string")
    keys = [r[0] for r in df.select(tx.sale_address_key("n", "t", "v", "p")).collect()]
    assert keys == ["12 AVENUE EVRY 91000", " X 75011"]

import datetime as dt

from transit_prices.operators import clean

RAW_COLS = ["sale_id", "date_mutation", "nature_mutation", "type_local", "rooms", "surface", "valeur_fonciere",
            "no_voie", "type_voie", "voie", "code_postal", "commune", "code_departement", "code_commune"]


def sale(i, **kw):
    base = dict(sale_id=str(i), date_mutation="01/02/2020", nature_mutation="Vente", type_local="Appartement",
                rooms="3", surface="50", valeur_fonciere="250 000,00", no_voie="12.0", type_voie="AV",
                voie="FOCH", code_postal="75016", commune="PARIS 16", code_departement="75", code_commune="116")
    base.update(kw)
    return tuple(base[c] for c in RAW_COLS)


def test_clean_sales_rules(spark):
    rows = [
        sale(1),
        sale(2, valeur_fonciere=""), sale(3, valeur_fonciere="abc"),
        sale(4, surface="8"), sale(5, surface="8,1", valeur_fonciere="20 000"), sale(6, surface="199,9"),
        sale(7, surface="200"), sale(8, rooms="10"), sale(9, rooms=None),
        sale(10, date_mutation="1/2/2020"), sale(11, date_mutation="2020-02-01"),
        sale(12, type_local="Local"), sale(13, nature_mutation="Echange"),
        sale(14, commune="Paris", code_commune="7"), sale(15, code_departement="1"),
        sale(16, valeur_fonciere="5 000"),   # 100 €/m²: below the price floor
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLS))
    out = {r["sale_id"]: r for r in clean.clean_sales(df).collect()}
    assert sorted(out, key=int) == ["1", "5", "6", "10", "11", "14", "15"]
    assert out["1"]["valeur_fonciere"] == 250000.0 and out["1"]["prix_m2"] == 5000.0
    assert out["1"]["code_commune"] == "056" and out["1"]["code_ville"] == "75056"
    assert out["1"]["commune"] == "paris 16" and out["1"]["annee"] == 2020 and out["1"]["mois"] == 2
    assert out["10"]["date_mutation"] == dt.date(2020, 2, 1)
    assert out["11"]["date_mutation"] is None            # strict format, kept with a null date
    assert out["14"]["code_commune"] == "007"            # 'paris' alone is not a district
    assert out["15"]["code_departement"] == "01"


def test_new_stations(spark):
    rows = [("48.81, 2.27", "B", " Interconnexion ", "L 15", "2016-01-01", "01/01/2024"),
            ("48.81", "A", "Non", "L 16", "inconnue", None),
            ("48.80, 2.20", "B", "?", "L 15", "2017-05-02", None)]
    df = spark.createDataFrame(rows, "geo_point string, nom_gare string, interconnexion string, lignes string, "
                                     "date_signature string, date_ouverture string")
    out = clean.clean_new_stations(df).orderBy("id_gare").collect()
    assert [r["id_gare"] for r in out] == [100000, 100001, 100002]
    assert [r["nom_gare"] for r in out] == ["A", "B", "B"]
    assert out[0]["latitude"] is None and out[2]["latitude"] == 48.81
    assert [r["interconnexion"] for r in out] == ["non", "non", "oui"] or \
        [r["interconnexion"] for r in out] == ["non", None, "oui"]
    assert out[2]["ligne_clean"] == "L15" and out[2]["annee_signature"] == 2016
    assert all(r["is_grand_paris"] == 1 for r in out)


def test_existing_stations(spark):
    rows = [(1, "X", "48.8, 2.3", "METRO", 1, "a", "e"), (2, "Y", "48.8, 2.3", "Tramway", 1, "a", "e"),
            (3, "Z", "48.8, 2.3", "VAL", 1, "a", "e"), (4, "W", "48.8, 2.3", None, 1, "a", "e"),
            (5, "V", "48.8, 2.3", "RER", 0, "a", "e")]
    df = spark.createDataFrame(rows, "gares_id int, nom_iv string, geo_point string, mode string, idf int, "
                                     "res_com string, exploitant string")
    out = clean.clean_existing_stations(df)
    assert out.columns == ["gares_id", "nom_iv", "res_com", "geo_point"]
    assert sorted(r["gares_id"] for r in out.collect()) == [1, 4]


def test_rates_first_per_month(spark):
    df = spark.createDataFrame([("2020-01-15", 2.0), ("2020-01-03", 1.0), ("2020-03-01", 3.0)], "date string, taux double")
    out = [(r["date"], r["taux"]) for r in clean.clean_rates(df).orderBy("date").collect()]
    assert out == [(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 3, 1), 3.0)]


def test_dedupe_first(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")], "k string, o int, v string")
    out = {r["k"]: r["v"] for r in clean.dedupe_first(df, "k", "o").collect()}
    assert out == {"a": "early", "b": "only"}


def test_assemble_frames(spark):
    import datetime as dt2

    a = spark.createDataFrame([(1, dt2.datetime(2020, 1, 1, 13, 0))], "id int, d timestamp")
    b = spark.createDataFrame([(2, "x")], "id int, extra string")
    out = clean.assemble_frames(a, b, ["d"]).orderBy("id").collect()
    assert out[0]["d"] == dt2.date(2020, 1, 1) and out[0]["extra"] is None and out[1]["d"] is None

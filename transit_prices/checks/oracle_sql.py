"""Oracle SQL (DuckDB) for the registered queries.

The CTEs below restate, in SQL, the adapter formulas of
``sources.adapters`` and the rules of each operator, so that the Spark plan
and an independent engine can be compared on the same driver tables. Double
outputs are rounded to 6 places on both sides.
"""

from __future__ import annotations

from ..functions.text import STREET_TYPES

R = 6
WS = "chr(32)||chr(9)||chr(10)||chr(13)||chr(11)||chr(12)"


def rnd(expr: str, alias: str) -> str:
    return f"round({expr}, {R}) AS {alias}"


def favg(expr: str) -> str:
    """Mean from a decimal sum, so that no summation order matters."""
    return f"(sum(CAST({expr} AS DECIMAL(28, 9)))::DOUBLE / count({expr}))"


def fold(expr: str, strip_first: bool = True) -> str:
    """NFKD + ASCII rule; Python upper-cases 'ß' to 'SS', DuckDB does not."""
    up = f"upper(replace({expr}, 'ß', 'SS'))"
    if strip_first:
        return f"regexp_replace(strip_accents(trim({up}, {WS})), '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(regexp_replace(strip_accents({up}), '[^\\x00-\\x7F]', '', 'g'), {WS})"


def _street_case(expr: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STREET_TYPES.items())
    return f"CASE {expr} {whens} ELSE {expr} END"


def _milli(expr: str) -> str:
    return f"CAST(({expr}) // 1000 AS VARCHAR) || '.' || lpad(CAST(({expr}) % 1000 AS VARCHAR), 3, '0')"


_PTS = (f"{_milli('48600 + 5 * ((s_suppkey * 53) % 100)')} || ', ' || "
        f"{_milli('2000 + 8 * ((s_suppkey * 29) % 100)')}")


def _hav(lat1, lon1, lat2, lon2) -> str:
    return (f"(2 * 6371e0 * asin(sqrt(least(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2), 1e0))))")


# ---------------------------------------------------------------------------
# Adapters and cleaners
# ---------------------------------------------------------------------------

CTE = {}

CTE["sales_base"] = """
sales_base AS (
  SELECT concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                   CAST(round(l.l_quantity) AS BIGINT), CAST(round(l.l_extendedprice * 100) AS BIGINT),
                   CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR)) AS sale_id,
         CAST(l.l_shipdate AS DATE) AS ship_date, l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         l.l_extendedprice, l.l_discount, l.l_returnflag, l.l_linestatus, o.o_custkey,
         n.n_nationkey, n.n_regionkey, n.n_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_NATURE = ("CASE WHEN l_linenumber = 5 THEN 'Echange' WHEN l_linestatus = 'F' THEN 'Vente' "
           "ELSE 'Vente en l''état futur d''achèvement' END")
_TYPE = "CASE WHEN l_returnflag = 'A' THEN 'Appartement' WHEN l_returnflag = 'R' THEN 'Maison' ELSE 'Local' END"

CTE["sales_raw"] = f"""
sales_raw AS (
  SELECT sale_id, l_orderkey AS order_key, strftime(ship_date, '%d/%m/%Y') AS date_mutation,
         {_NATURE} AS nature_mutation, {_TYPE} AS type_local,
         CAST(l_linenumber AS VARCHAR) AS rooms,
         replace(CAST(l_quantity * 4 AS VARCHAR), '.', ',') AS surface,
         replace(CAST(round(l_extendedprice * 10, 2) AS VARCHAR), '.', ',') AS valeur_fonciere,
         CAST(o_custkey // 4 AS VARCHAR) AS no_voie,
         CASE WHEN o_custkey % 2 = 0 THEN 'AV' ELSE 'RUE' END AS type_voie,
         n_name AS voie, CAST(75000 + n_nationkey AS VARCHAR) AS code_postal, n_name AS commune,
         CAST(n_regionkey AS VARCHAR) AS code_departement, CAST(n_nationkey AS VARCHAR) AS code_commune
  FROM sales_base)"""

CTE["sales_typed"] = f"""
sales_typed AS (
  SELECT sale_id, l_suppkey AS station, ship_date AS date, {_NATURE} AS nature_mutation, {_TYPE} AS type_local,
         CAST(l_linenumber AS DOUBLE) AS rooms, l_quantity * 4 AS surface,
         round(l_extendedprice * 10, 2) AS valeur_fonciere,
         round(l_extendedprice * 10, 2) / (l_quantity * 4) AS prix_m2, l_discount AS discount
  FROM sales_base)"""

_NUM = "TRY_CAST(replace(replace(coalesce({c}, ''), ' ', ''), ',', '.') AS DOUBLE)"

CTE["sales_clean"] = f"""
sales_parsed AS (
  SELECT sale_id, order_key, CAST(try_strptime(date_mutation, '%d/%m/%Y') AS DATE) AS date_mutation,
         nature_mutation, type_local,
         {_NUM.format(c='valeur_fonciere')} AS valeur_fonciere, {_NUM.format(c='surface')} AS surface,
         TRY_CAST(rooms AS DOUBLE) AS rooms, no_voie, type_voie, voie, code_postal,
         lower(trim(commune)) AS commune, code_departement, code_commune
  FROM sales_raw),
sales_clean AS (
  SELECT sale_id, order_key, date_mutation, CAST(year(date_mutation) AS INTEGER) AS annee,
         CAST(month(date_mutation) AS INTEGER) AS mois, nature_mutation, type_local, valeur_fonciere, surface,
         valeur_fonciere / surface AS prix_m2, rooms, no_voie, type_voie, voie, code_postal, commune,
         dep AS code_departement, com AS code_commune, dep || com AS code_ville
  FROM (SELECT *,
          CASE WHEN length(code_departement) < 2 THEN lpad(code_departement, 2, '0') ELSE code_departement END AS dep,
          CASE WHEN contains(commune, 'paris ') THEN '056'
               WHEN length(code_commune) < 3 THEN lpad(code_commune, 3, '0') ELSE code_commune END AS com
        FROM sales_parsed)
  WHERE type_local IN ('Appartement', 'Maison')
    AND nature_mutation IN ('Vente', 'Vente en l''état futur d''achèvement')
    AND valeur_fonciere > 1000 AND surface > 8 AND surface < 200 AND rooms < 10
    AND valeur_fonciere / surface > 1000 AND valeur_fonciere / surface < 13000)"""

CTE["register"] = """
register AS (
  SELECT CAST(c.c_custkey // 4 AS VARCHAR) AS numero,
         (CASE WHEN c.c_custkey % 2 = 0 THEN 'AVENUE ' ELSE 'RUE ' END) || n.n_name AS nom_voie,
         CAST(75000 + n.n_nationkey AS VARCHAR) AS code_postal, n.n_name AS nom_commune,
         2e0 + ((c.c_custkey * 91) % 1000) / 1250e0 AS lon,
         48.6e0 + ((c.c_custkey * 37) % 1000) / 2000e0 AS lat
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_SALE_KEY = ("upper(regexp_replace(coalesce(no_voie, ''), '\\.0$', '') || ' ' || "
             + fold(f"coalesce({_street_case('type_voie')}, '') || ' ' || coalesce(voie, '')")
             + " || ' ' || substr(regexp_replace(code_postal, '\\.0$', ''), 1, 5))")

CTE["sales_keyed"] = f"""
sales_keyed AS (SELECT *, {_SALE_KEY} AS adresse_complete FROM sales_clean)"""

CTE["register_keyed"] = f"""
register_keyed AS (
  SELECT upper(numero || ' ' || {fold('nom_voie')} || ' ' || code_postal) AS adresse_complete, lon, lat
  FROM register)"""

CTE["geocoded"] = """
geocoded AS (
  SELECT s.* EXCLUDE (adresse_complete, no_voie, type_voie, voie, code_postal, commune, code_departement, code_commune),
         r.lon, r.lat
  FROM sales_keyed s JOIN register_keyed r ON s.adresse_complete = r.adresse_complete)"""

CTE["new_stations_raw"] = f"""
new_stations_raw AS (
  SELECT CASE WHEN s_suppkey % 23 = 0 THEN '48.7' ELSE {_PTS} END AS geo_point, s_name AS nom_gare,
         CASE WHEN s_suppkey % 3 = 0 THEN ' Interconnexion ' WHEN s_suppkey % 3 = 1 THEN 'Non' ELSE '?' END AS interconnexion,
         'L ' || CAST(s_nationkey % 5 + 14 AS VARCHAR) AS lignes,
         CASE WHEN s_suppkey % 17 = 0 THEN 'inconnue' ELSE CAST(1996 + s_suppkey % 4 AS VARCHAR) || '-01-01' END AS date_signature,
         '01/01/' || CAST(1998 + s_suppkey % 4 AS VARCHAR) AS date_ouverture
  FROM supplier WHERE s_suppkey % 2 = 0)"""


def _geo_part(col: str, i: int) -> str:
    return f"TRY_CAST(trim(split_part({col}, ',', {i})) AS DOUBLE)"


_GEO_OK = f"(len(string_split(geo_point, ',')) = 2 AND {_geo_part('geo_point', 1)} IS NOT NULL AND {_geo_part('geo_point', 2)} IS NOT NULL)"
_DATE_L = "CAST(coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%d/%m/%Y')) AS DATE)"

CTE["new_stations"] = f"""
new_stations_p AS (
  SELECT nom_gare,
         CASE WHEN {_GEO_OK} THEN {_geo_part('geo_point', 1)} END AS latitude,
         CASE WHEN {_GEO_OK} THEN {_geo_part('geo_point', 2)} END AS longitude,
         CASE lower(trim(interconnexion)) WHEN 'interconnexion' THEN 'oui' WHEN 'non' THEN 'non' END AS interconnexion,
         replace(lignes, ' ', '') AS ligne_clean,
         {_DATE_L.format(c='date_signature')} AS date_signature,
         {_DATE_L.format(c='date_ouverture')} AS date_ouverture
  FROM new_stations_raw),
new_stations AS (
  SELECT *, CAST(row_number() OVER (ORDER BY nom_gare NULLS LAST, latitude NULLS LAST, longitude NULLS LAST,
                                    ligne_clean NULLS LAST, date_signature NULLS LAST) - 1 + 100000 AS INTEGER) AS id_gare,
         1 AS is_grand_paris, CAST(year(date_signature) AS INTEGER) AS annee_signature
  FROM new_stations_p)"""

CTE["existing_stations"] = f"""
existing_stations_raw AS (
  SELECT s_suppkey AS gares_id, s_name AS nom_iv, {_PTS} AS geo_point,
         CASE s_nationkey % 5 WHEN 0 THEN 'METRO' WHEN 1 THEN 'RER' WHEN 2 THEN 'Tramway' WHEN 3 THEN 'VAL' END AS mode,
         CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 1 END AS idf, 'RES_' || CAST(s_nationkey AS VARCHAR) AS res_com
  FROM supplier WHERE s_suppkey % 2 = 1),
existing_stations AS (
  SELECT gares_id, nom_iv, res_com, geo_point FROM existing_stations_raw
  WHERE NOT coalesce(regexp_matches(upper(mode), 'VAL|TRAM|TRAMWAY|TRAIN'), false) AND idf = 1)"""

CTE["all_stations"] = f"""
all_stations AS (
  SELECT id_gare, nom_gare, latitude, longitude, is_grand_paris, annee_signature FROM new_stations
  UNION ALL
  SELECT CAST(gares_id AS INTEGER), nom_iv,
         CASE WHEN {_GEO_OK} THEN {_geo_part('geo_point', 1)} END,
         CASE WHEN {_GEO_OK} THEN {_geo_part('geo_point', 2)} END, 0, CAST(NULL AS INTEGER)
  FROM existing_stations)"""

CTE["hist_stations"] = """
hist_stations AS (
  SELECT * FROM all_stations a WHERE NOT EXISTS (SELECT 1 FROM new_stations n WHERE n.nom_gare = a.nom_gare))"""

CTE["rates"] = """
rates_daily_raw AS (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, avg(o_totalprice) / 100000e0 AS taux
  FROM orders GROUP BY CAST(o_orderdate AS DATE)),
rates AS (
  SELECT date, taux FROM (
    SELECT CAST(date_trunc('month', CAST(date AS DATE)) AS DATE) AS date, taux,
           row_number() OVER (PARTITION BY date_trunc('month', CAST(date AS DATE)) ORDER BY CAST(date AS DATE), taux) AS rn
    FROM rates_daily_raw) WHERE rn = 1)"""

CTE["rates_ym"] = """
rates_m AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice) / 100000e0 AS taux
  FROM orders GROUP BY 1),
rates_ym AS (
  SELECT CAST(year(m.month) AS INTEGER) AS annee, CAST(month(m.month) AS INTEGER) AS mois, m.taux,
         m.taux - p1.taux AS variation_mom, m.taux - p12.taux AS variation_yoy
  FROM rates_m m
  LEFT JOIN rates_m p1 ON CAST(p1.month + INTERVAL 1 MONTH AS DATE) = m.month
  LEFT JOIN rates_m p12 ON CAST(p12.month + INTERVAL 12 MONTH AS DATE) = m.month)"""


def _ind_block(where: str, src: int) -> str:
    seg = "c_mktsegment"
    share = lambda v: f"avg(CASE WHEN {seg} = '{v}' THEN 1e0 ELSE 0e0 END)"
    return f"""SELECT c_nationkey, avg(c_acctbal) AS revenu_median_2021, count(*) / 100e0 AS evo_population_2016_2022,
         {share('BUILDING')} AS part_proprio_2022, {share('AUTOMOBILE')} AS part_hlm_2022,
         {share('MACHINERY')} AS part_cadres_2022, {share('HOUSEHOLD')} AS part_log_vacants_2022,
         {share('FURNITURE')} AS taux_chomage_2024,
         avg(CASE WHEN c_acctbal < 0 THEN 1e0 ELSE 0e0 END) AS part_eleves_prive_2024,
         CAST(count(*) AS DOUBLE) AS nb_etablissements_2023, {src} AS src_row
  FROM customer {where} GROUP BY c_nationkey"""


CTE["indicators"] = f"""
ind_blocks AS ({_ind_block('', 0)} UNION ALL {_ind_block('WHERE c_acctbal > 0', 1)}),
indicators AS (
  SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code_ville,
         lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS departement,
         CASE WHEN n_nationkey % 3 = 0 THEN replace(n_name, 'NATION', 'Nätion') ELSE n_name END AS ville,
         b.* EXCLUDE (c_nationkey)
  FROM ind_blocks b JOIN nation n ON b.c_nationkey = n.n_nationkey
  WHERE src_row = 0 OR n_nationkey % 6 = 0),
indicators_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY code_ville ORDER BY src_row) AS rn FROM indicators) WHERE rn = 1)"""

CTE["communes"] = """
communes AS (
  SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS code_insee,
         lower(n_name) AS commune
  FROM nation WHERE n_nationkey % 5 <> 0)"""

CTE["station_address"] = f"""
station_address AS (
  SELECT id_gare, code_postal, nom_commune AS ville,
         CASE WHEN length(code_postal) >= 2 THEN substr(code_postal, 1, 2) END AS departement, d AS address_distance_km
  FROM (
    SELECT s.id_gare, r.code_postal, r.nom_commune, r.numero, r.nom_voie,
           {_hav('s.latitude', 's.longitude', 'r.lat', 'r.lon')} AS d
    FROM new_stations s, register r WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY id_gare ORDER BY round(d, 9), code_postal, nom_commune, numero, nom_voie) = 1)"""

CTE["stations_prep"] = f"""
stations_located AS (
  SELECT n.*, a.code_postal, a.ville, a.departement, a.address_distance_km
  FROM new_stations n LEFT JOIN station_address a ON n.id_gare = a.id_gare),
stations_prep AS (
  SELECT CAST(s.id_gare - 100000 AS INTEGER) AS station_id, s.nom_gare, s.latitude, s.longitude, s.ligne_clean,
         CAST(coalesce(s.departement, c.departement) AS VARCHAR) AS departement,
         s.date_signature, s.date_ouverture, c.code_ville
  FROM stations_located s
  LEFT JOIN (SELECT code_ville, {fold('ville', False)} AS vn, departement FROM indicators_dedup) c
    ON {fold('s.ville', False)} = c.vn)"""

CTE["enriched"] = f"""
geo_rows AS (SELECT *, ln(prix_m2) AS log_prix_m2, row_number() OVER () AS rid FROM geocoded),
near_gp AS (
  SELECT rid, station_id, d AS distance_gp_km FROM (
    SELECT g.rid, s.station_id, {_hav('g.lat', 'g.lon', 's.latitude', 's.longitude')} AS d
    FROM geo_rows g, stations_prep s WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY round(d, 9), station_id) = 1),
near_hist AS (
  SELECT rid, id_gare AS hist_id, d AS distance_hist_km FROM (
    SELECT g.rid, s.id_gare, {_hav('g.lat', 'g.lon', 's.latitude', 's.longitude')} AS d
    FROM geo_rows g, hist_stations s WHERE s.latitude IS NOT NULL AND s.longitude IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY round(d, 9), id_gare) = 1),
enriched AS (
  SELECT g.*, a.station_id, a.distance_gp_km, h.hist_id, h.distance_hist_km,
         i.departement, i.ville, i.revenu_median_2021, i.evo_population_2016_2022, i.part_proprio_2022,
         i.part_hlm_2022, i.part_cadres_2022, i.part_log_vacants_2022, i.taux_chomage_2024,
         i.part_eleves_prive_2024, i.nb_etablissements_2023,
         coalesce(a.distance_gp_km <= 3e0, false) AS is_gp,
         CAST(coalesce(a.distance_gp_km <= 3e0, false) AS INTEGER) AS d_gp,
         coalesce(h.distance_hist_km <= 3e0, false) AS is_hist,
         CAST(date_trunc('month', g.date_mutation) AS DATE) AS date, r.taux
  FROM geo_rows g
  LEFT JOIN near_gp a ON g.rid = a.rid
  LEFT JOIN near_hist h ON g.rid = h.rid
  LEFT JOIN indicators i ON g.code_ville = i.code_ville
  LEFT JOIN rates r ON CAST(date_trunc('month', g.date_mutation) AS DATE) = r.date)"""

_PANEL_IND = {
    "revenu_median_2021": "revenu_median_2021",
    "taux_chomage_2024": "taux_chomage_2024",
    "evo_population_2016_2022": "evo_population_2016_2022",
    "part_hlm_2022": "part_hlm_2022",
    "part_cadres_2022": "part_cadres_2022",
    "part_log_vacants_2022": "part_log_vacants_2022",
    "part_diplomes_2024": "part_eleves_prive_2024",
    "nb_entreprises_2023": "nb_etablissements_2023",
}

CTE["panel"] = f"""
treated_monthly AS (
  SELECT t.*, s.nom_gare, s.ligne_clean, s.departement, s.date_signature, s.date_ouverture,
         CAST(year(t.date) - year(s.date_signature) AS INTEGER) AS relative_signature_year
  FROM (SELECT station_id, date, {favg('prix_m2')} AS prix_m2_mean, count(*) AS n_transactions,
               {', '.join(f'avg({v}) AS {k}' for k, v in _PANEL_IND.items())}
        FROM enriched WHERE is_gp GROUP BY station_id, date) t
  LEFT JOIN stations_prep s ON t.station_id = s.station_id),
control_hist AS (
  SELECT date, {favg('prix_m2')} AS prix_control_hist, count(*) AS n_control_hist
  FROM enriched WHERE NOT is_gp AND is_hist GROUP BY date),
control_rest AS (
  SELECT date, {favg('prix_m2')} AS prix_control_rest, count(*) AS n_control_rest
  FROM enriched WHERE NOT is_gp GROUP BY date),
full_panel AS (
  SELECT t.*, r.taux, h.prix_control_hist, h.n_control_hist, c.prix_control_rest, c.n_control_rest
  FROM treated_monthly t LEFT JOIN rates r ON t.date = r.date
  LEFT JOIN control_hist h ON t.date = h.date LEFT JOIN control_rest c ON t.date = c.date)"""

# dependency order of the CTE blocks
ORDER = ["sales_base", "sales_raw", "sales_typed", "sales_clean", "register", "sales_keyed", "register_keyed",
         "geocoded", "new_stations_raw", "new_stations", "existing_stations", "all_stations", "hist_stations",
         "rates", "rates_ym", "indicators", "communes", "station_address", "stations_prep", "enriched", "panel"]

DEPS = {
    "sales_raw": ["sales_base"], "sales_typed": ["sales_base"], "sales_clean": ["sales_raw"],
    "sales_keyed": ["sales_clean"], "register_keyed": ["register"], "geocoded": ["sales_keyed", "register_keyed"],
    "new_stations": ["new_stations_raw"], "all_stations": ["new_stations", "existing_stations"],
    "hist_stations": ["all_stations"], "station_address": ["new_stations", "register"],
    "stations_prep": ["station_address", "indicators"],
    "enriched": ["geocoded", "stations_prep", "hist_stations", "indicators", "rates"],
    "panel": ["enriched", "stations_prep", "rates"],
}


def with_ctes(needs, body: str) -> str:
    todo, seen = list(needs), set()
    while todo:
        n = todo.pop()
        if n not in seen:
            seen.add(n)
            todo.extend(DEPS.get(n, []))
    blocks = [CTE[n].strip() for n in ORDER if n in seen]
    return "WITH " + ",\n".join(blocks) + "\n" + body


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

Q = {}

Q["commune_year_prices"] = with_ctes(["sales_clean", "communes"], f"""
, f AS (
  SELECT CASE WHEN length(code_ville) < 5 THEN lpad(code_ville, 5, '0') ELSE code_ville END AS code_insee,
         commune, annee, prix_m2 FROM sales_clean WHERE annee BETWEEN 1996 AND 2000),
s AS (SELECT * FROM f WHERE code_insee IN (SELECT code_insee FROM communes)),
y AS (SELECT code_insee, commune, annee, {favg('prix_m2')} AS m, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT code_insee, commune, {favg('prix_m2')} AS mp, count(*) AS np FROM s GROUP BY ALL),
ny AS (SELECT count(DISTINCT annee) AS k FROM f)
SELECT y.code_insee, y.commune, y.annee, {rnd('y.m', 'prix_m2_moyen')}, y.n AS nb_tx_annee,
       {rnd('p.mp', 'prix_m2_moyen_periode')}, p.np AS nb_tx_periode, {rnd('p.np / ny.k', 'nb_tx_moyen_par_an')}
FROM y LEFT JOIN p ON y.code_insee = p.code_insee AND y.commune = p.commune CROSS JOIN ny""").replace("\n, f AS", ",\nf AS", 1)

Q["price_quantiles"] = with_ctes(["sales_clean", "communes"], f"""
, s AS (
  SELECT code_ville AS code_insee, commune, annee, prix_m2 FROM sales_clean
  WHERE annee BETWEEN 1996 AND 2000 AND code_ville IN (SELECT code_insee FROM communes)),
y AS (SELECT code_insee, commune, annee, {favg('prix_m2')} AS m FROM s GROUP BY ALL)
SELECT {rnd('quantile_cont(m, 0.05)', 'q05')}, {rnd('quantile_cont(m, 0.95)', 'q95')} FROM y""").replace("\n, s AS", ",\ns AS", 1)

Q["mean_by_dimension"] = with_ctes(["sales_clean"], f"""
SELECT commune, {rnd(favg('prix_m2'), 'prix_moyen_agg')} FROM sales_clean GROUP BY commune""")

Q["clean_sales"] = with_ctes(["sales_clean"], f"""
SELECT sale_id, date_mutation, annee, mois, nature_mutation, type_local, {rnd('valeur_fonciere', 'valeur_fonciere')},
       {rnd('surface', 'surface')}, {rnd('prix_m2', 'prix_m2')}, {rnd('rooms', 'rooms')}, no_voie, type_voie, voie,
       code_postal, commune, code_departement, code_commune, code_ville
FROM sales_clean""")

Q["clean_new_stations"] = with_ctes(["new_stations"], f"""
SELECT nom_gare, {rnd('latitude', 'latitude')}, {rnd('longitude', 'longitude')}, interconnexion, ligne_clean,
       date_signature, date_ouverture, id_gare, is_grand_paris, annee_signature
FROM new_stations""")

Q["clean_existing_stations"] = with_ctes(["existing_stations"], """
SELECT gares_id, nom_iv, res_com, geo_point FROM existing_stations""")

Q["station_union"] = with_ctes(["all_stations"], f"""
SELECT id_gare, nom_gare, {rnd('latitude', 'latitude')}, {rnd('longitude', 'longitude')}, is_grand_paris, annee_signature
FROM all_stations""")

Q["fold_accents"] = f"SELECT doc_id, {fold('text', True)} AS folded FROM documents"

Q["rates_month"] = with_ctes(["rates"], f"SELECT date, {rnd('taux', 'taux')} FROM rates")

Q["address_key"] = with_ctes(["sales_keyed"], "SELECT sale_id, adresse_complete FROM sales_keyed")

Q["geocode_sales"] = with_ctes(["geocoded"], f"""
SELECT sale_id, code_ville, {rnd('prix_m2', 'prix_m2')}, {rnd('lon', 'lon')}, {rnd('lat', 'lat')} FROM geocoded""")

Q["nearest_station"] = with_ctes(["enriched"], f"""
SELECT g.sale_id, {rnd('g.lat', 'lat')}, {rnd('g.lon', 'lon')}, {rnd('a.distance_gp_km', 'gp_distance_km')},
       a.station_id AS gp_id
FROM geo_rows g LEFT JOIN near_gp a ON g.rid = a.rid""")

Q["nearest_station_attrs"] = with_ctes(["enriched"], f"""
SELECT g.sale_id, {rnd('g.lat', 'lat')}, {rnd('g.lon', 'lon')}, {rnd('a.distance_gp_km', 'distance_gare_km')},
       s.nom_gare AS nearest_gare, s.date_signature, s.date_ouverture,
       {rnd('s.latitude', 'lat_gare')}, {rnd('s.longitude', 'lon_gare')}
FROM geo_rows g LEFT JOIN near_gp a ON g.rid = a.rid LEFT JOIN stations_prep s ON a.station_id = s.station_id""")

Q["nearest_address"] = with_ctes(["station_address"], f"""
SELECT n.id_gare, n.nom_gare, a.code_postal, a.ville, a.departement, {rnd('a.address_distance_km', 'address_distance_km')}
FROM new_stations n LEFT JOIN station_address a ON n.id_gare = a.id_gare""")

Q["station_city_codes"] = with_ctes(["stations_prep"], f"""
SELECT station_id, nom_gare, {rnd('latitude', 'latitude')}, {rnd('longitude', 'longitude')}, ligne_clean, departement,
       date_signature, date_ouverture, code_ville
FROM stations_prep""")

Q["join_rates"] = with_ctes(["sales_clean", "rates"], f"""
SELECT s.sale_id, CAST(date_trunc('month', s.date_mutation) AS DATE) AS date, {rnd('r.taux', 'taux')}
FROM sales_clean s LEFT JOIN rates r ON CAST(date_trunc('month', s.date_mutation) AS DATE) = r.date""")

Q["join_rates_ym"] = with_ctes(["sales_clean", "rates_ym"], f"""
SELECT s.sale_id, s.annee, s.mois, {rnd('r.taux', 'taux')}, {rnd('r.variation_mom', 'variation_mom')},
       {rnd('r.variation_yoy', 'variation_yoy')}
FROM sales_clean s LEFT JOIN rates_ym r ON s.annee = r.annee AND s.mois = r.mois""")

_IND_SEL = (f"s.sale_id, s.code_ville, i.departement, i.ville, {rnd('i.revenu_median_2021', 'revenu_median_2021')}, "
            f"{rnd('i.part_hlm_2022', 'part_hlm_2022')}, {rnd('i.nb_etablissements_2023', 'nb_etablissements_2023')}")

Q["join_indicators"] = with_ctes(["sales_clean", "indicators"], f"""
SELECT {_IND_SEL} FROM sales_clean s LEFT JOIN indicators i ON s.code_ville = i.code_ville""")

Q["join_indicators_dedup"] = with_ctes(["sales_clean", "indicators"], f"""
SELECT {_IND_SEL} FROM sales_clean s LEFT JOIN indicators_dedup i ON s.code_ville = i.code_ville""")

Q["proximity_flags"] = with_ctes(["enriched"], f"""
SELECT sale_id, {rnd('lat', 'lat')}, {rnd('lon', 'lon')}, station_id, {rnd('distance_gp_km', 'distance_gp_km')}, hist_id,
       {rnd('distance_hist_km', 'distance_hist_km')}, is_gp, is_hist, d_gp
FROM enriched""")

Q["relative_years"] = with_ctes(["enriched", "rates_ym"], f"""
, pf AS (
  SELECT g.*, a.distance_gp_km AS distance_gare_km, s.nom_gare AS nearest_gare, s.date_signature, s.date_ouverture
  FROM geo_rows g LEFT JOIN near_gp a ON g.rid = a.rid LEFT JOIN stations_prep s ON a.station_id = s.station_id),
pf2 AS (
  SELECT *, CAST(year(date_mutation) - year(date_signature) AS INTEGER) AS relative_signature,
         CAST(year(date_mutation) - year(date_ouverture) AS INTEGER) AS relative_opening FROM pf)
SELECT p.sale_id, {rnd('p.lat', 'lat')}, {rnd('p.lon', 'lon')}, p.nearest_gare, {rnd('p.distance_gare_km', 'distance_gare_km')},
       p.relative_signature, p.relative_opening,
       CAST(coalesce(p.relative_opening <= 5 AND p.distance_gare_km < 1, false) AS INTEGER) AS is_new_gare,
       {rnd('r.taux', 'taux')}, {rnd('r.variation_yoy', 'variation_yoy')}, {rnd('i.revenu_median_2021', 'revenu_median_2021')}
FROM pf2 p LEFT JOIN rates_ym r ON p.annee = r.annee AND p.mois = r.mois
LEFT JOIN indicators_dedup i ON p.code_ville = i.code_ville""").replace("\n, pf AS", ",\npf AS", 1)

_TP_COLS = ", ".join(["station_id", "date", rnd("prix_m2_mean", "prix_m2_mean"), "n_transactions"]
                     + [rnd(k, k) for k in _PANEL_IND]
                     + ["nom_gare", "ligne_clean", "departement", "date_signature", "date_ouverture", "relative_signature_year"])

Q["treated_panel"] = with_ctes(["panel"], f"SELECT {_TP_COLS} FROM treated_monthly")

Q["control_series_hist"] = with_ctes(["panel"], f"""
SELECT date, {rnd('prix_control_hist', 'prix_control_hist')}, n_control_hist FROM control_hist""")

Q["control_series_rest"] = with_ctes(["panel"], f"""
SELECT date, {rnd('prix_control_rest', 'prix_control_rest')}, n_control_rest FROM control_rest""")

Q["full_panel"] = with_ctes(["panel"], f"""
SELECT station_id, date, {rnd('prix_m2_mean', 'prix_m2_mean')}, n_transactions, {rnd('taux', 'taux')},
       {rnd('prix_control_hist', 'prix_control_hist')}, n_control_hist, {rnd('prix_control_rest', 'prix_control_rest')},
       n_control_rest, relative_signature_year
FROM full_panel""")

Q["did_by_group"] = with_ctes(["panel"], f"""
, u AS (
  SELECT station_id, (prix_m2_mean / prix_control_rest - 1e0) * 100e0 AS g, n_transactions AS t,
         relative_signature_year AS rel
  FROM full_panel
  WHERE prix_m2_mean IS NOT NULL AND prix_control_rest IS NOT NULL AND relative_signature_year IS NOT NULL),
pre AS (SELECT station_id, g, t FROM u WHERE rel BETWEEN -5 AND -1),
post AS (SELECT station_id, g, t FROM u WHERE rel BETWEEN 0 AND 10),
a_pre AS (SELECT station_id, avg(g) AS pre_mean, count(*) AS n_pre, CAST(sum(t) AS BIGINT) AS n_tx_pre FROM pre GROUP BY 1),
a_post AS (SELECT station_id, avg(g) AS post_mean, count(*) AS n_post, CAST(sum(t) AS BIGINT) AS n_tx_post FROM post GROUP BY 1),
sg AS (SELECT station_id, -g AS sd FROM pre UNION ALL SELECT station_id, g FROM post),
a_ci AS (SELECT station_id, stddev_samp(sd) AS sdev, count(*) AS n_obs FROM sg GROUP BY 1)
SELECT a.station_id, {rnd('a.pre_mean', 'pre_mean')}, a.n_pre, a.n_tx_pre, {rnd('b.post_mean', 'post_mean')}, b.n_post,
       b.n_tx_post, {rnd('b.post_mean - a.pre_mean', 'ate_pct')}, c.n_obs, a.n_tx_pre + b.n_tx_post AS n_transactions,
       {rnd('(b.post_mean - a.pre_mean) - 1.96e0 * c.sdev / sqrt(c.n_obs)', 'ci_low_pct')},
       {rnd('(b.post_mean - a.pre_mean) + 1.96e0 * c.sdev / sqrt(c.n_obs)', 'ci_high_pct')}
FROM a_pre a JOIN a_post b ON a.station_id = b.station_id LEFT JOIN a_ci c ON a.station_id = c.station_id""").replace("\n, u AS", ",\nu AS", 1)


def oracle_queries() -> dict:
    return dict(Q)


# ---------------------------------------------------------------------------
# Part 2: panels, splits, sequences, scaling, metrics, Double ML, coverage
# ---------------------------------------------------------------------------

CTE["supplier_panel"] = f"""
sp_agg AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS date, station, count(*) AS n_transactions,
         {favg('prix_m2')} AS prix_m2, {favg('rooms')} AS rooms, {favg('surface')} AS surface,
         {favg('discount')} AS discount,
         sum(CASE WHEN type_local = 'Appartement' THEN 1e0 ELSE 0e0 END) / count(*) AS share_appartement,
         sum(CASE WHEN nature_mutation = 'Vente' THEN 1e0 ELSE 0e0 END) / count(*) AS share_vente
  FROM sales_typed WHERE station IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2),
sp_complete AS (
  SELECT * FROM sp_agg WHERE station IN (
    SELECT station FROM sp_agg GROUP BY station
    HAVING count(DISTINCT date) = (SELECT count(DISTINCT date) FROM sp_agg)))"""
DEPS["supplier_panel"] = ["sales_typed"]
ORDER.append("supplier_panel")

_SP_COLS = ("station, date, n_transactions, " + ", ".join(rnd(c, c) for c in
            ["prix_m2", "rooms", "surface", "discount", "share_appartement", "share_vente"]))

Q["station_month_features"] = with_ctes(["supplier_panel"], f"SELECT {_SP_COLS} FROM sp_complete")
Q["station_month_features_all"] = with_ctes(["supplier_panel"], f"SELECT {_SP_COLS} FROM sp_agg")


def _mode_of(col):
    return f"(SELECT {col} FROM sales_typed GROUP BY 1 ORDER BY count(*) DESC, {col} LIMIT 1)"


Q["station_month_features_mode"] = with_ctes(["sales_typed"], f"""
, a AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS date, station, count(*) AS n_transactions,
         {favg('rooms')} AS rooms, {favg('surface')} AS surface, {favg('discount')} AS discount, {favg('prix_m2')} AS prix_m2,
         sum(CASE WHEN type_local = {_mode_of('type_local')} THEN 1e0 ELSE 0e0 END) / count(*) AS type_local_share,
         sum(CASE WHEN nature_mutation = {_mode_of('nature_mutation')} THEN 1e0 ELSE 0e0 END) / count(*) AS nature_mutation_share
  FROM sales_typed WHERE station IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2),
c AS (SELECT * FROM a WHERE station IN (SELECT station FROM a GROUP BY station
      HAVING count(DISTINCT date) = (SELECT count(DISTINCT date) FROM a)))
SELECT station, date, n_transactions, {', '.join(rnd(x, x) for x in ['rooms', 'surface', 'discount', 'prix_m2', 'type_local_share', 'nature_mutation_share'])}
FROM c""").replace("\n, a AS", ",\na AS", 1)


def _group_mode(col):
    return f"""{col}_m AS (
  SELECT date, station, v AS {col} FROM (
    SELECT CAST(date_trunc('month', date) AS DATE) AS date, station, {col} AS v, count(*) AS c
    FROM sales_typed WHERE {col} IS NOT NULL GROUP BY 1, 2, 3)
  QUALIFY row_number() OVER (PARTITION BY date, station ORDER BY c DESC, v) = 1)"""


Q["station_month_modes"] = with_ctes(["sales_typed"], f"""
, a AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS date, station, {favg('prix_m2')} AS prix_m2, {favg('surface')} AS surface
  FROM sales_typed WHERE station IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2),
{_group_mode('type_local')},
{_group_mode('nature_mutation')}
SELECT a.station, a.date, {rnd('a.prix_m2', 'prix_m2')}, {rnd('a.surface', 'surface')}, t.type_local, n.nature_mutation
FROM a JOIN type_local_m t ON a.date = t.date AND a.station = t.station
JOIN nature_mutation_m n ON a.date = n.date AND a.station = n.station""").replace("\n, a AS", ",\na AS", 1)

Q["chrono_split"] = with_ctes(["sales_clean"], """
, k AS (SELECT * FROM sales_clean WHERE annee BETWEEN 1996 AND 2000)
SELECT sale_id, annee,
       CASE WHEN row_number() OVER (ORDER BY annee, date_mutation, sale_id) - 1 < (SELECT floor(count(*) * 0.8e0) FROM k)
            THEN 'train' ELSE 'test' END AS split
FROM k""").replace("\n, k AS", ",\nk AS", 1)

Q["date_split"] = with_ctes(["supplier_panel"], """
SELECT station, date, split FROM (
  SELECT station, date, CASE WHEN date < DATE '2000-01-01' THEN 'train'
                             WHEN date BETWEEN DATE '2000-01-01' AND DATE '2000-12-01' THEN 'test' END AS split
  FROM sp_complete) WHERE split IS NOT NULL""")

Q["last_n_split"] = with_ctes(["supplier_panel"], """
SELECT station, date,
       CASE WHEN count(*) OVER (PARTITION BY station) <= 24 THEN 'reject'
            WHEN row_number() OVER (PARTITION BY station ORDER BY date DESC) <= 24 THEN 'test' ELSE 'train' END AS split
FROM sp_complete""")

_SEQ_W = "WINDOW w AS (PARTITION BY station ORDER BY date)"

Q["sequences_single"] = with_ctes(["supplier_panel"], f"""
, s AS (
  SELECT station, date, prix_m2, row_number() OVER w AS rn,
         sum(n_transactions) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS x_sum,
         first_value(n_transactions) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS x_first,
         last_value(n_transactions) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS x_last
  FROM sp_complete {_SEQ_W})
SELECT station, date, CAST(x_sum AS DOUBLE) AS x_sum, CAST(x_first AS DOUBLE) AS x_first,
       CAST(x_last AS DOUBLE) AS x_last, {rnd('prix_m2', 'y')}
FROM s WHERE rn > 12""").replace("\n, s AS", ",\ns AS", 1)

Q["sequences_multi"] = with_ctes(["supplier_panel"], f"""
, s AS (
  SELECT station, date, row_number() OVER w AS rn,
         sum(n_transactions) OVER (w ROWS BETWEEN 18 PRECEDING AND 1 PRECEDING) AS x_sum,
         first_value(n_transactions) OVER (w ROWS BETWEEN 18 PRECEDING AND 1 PRECEDING) AS x_first,
         last_value(n_transactions) OVER (w ROWS BETWEEN 18 PRECEDING AND 1 PRECEDING) AS x_last,
         list(prix_m2) OVER (w ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS ys
  FROM sp_complete {_SEQ_W})
SELECT station, date, CAST(x_sum AS DOUBLE) AS x_sum, CAST(x_first AS DOUBLE) AS x_first,
       CAST(x_last AS DOUBLE) AS x_last, {rnd('ys[1]', 'y_first')}, {rnd('ys[6]', 'y_last')},
       CAST(len(ys) AS INTEGER) AS y_len
FROM s WHERE rn > 18 AND len(ys) = 6""").replace("\n, s AS", ",\ns AS", 1)

Q["positional_split"] = with_ctes(["supplier_panel"], f"""
, s AS (SELECT station, date FROM (SELECT station, date, row_number() OVER w AS rn FROM sp_complete {_SEQ_W}) WHERE rn > 12)
SELECT station, date,
       CASE WHEN row_number() OVER (ORDER BY station, date) - 1 < (SELECT floor(count(*) * 0.8e0) FROM s)
            THEN 'train' ELSE 'test' END AS split
FROM s""").replace("\n, s AS", ",\ns AS", 1)

Q["prediction_window"] = with_ctes(["supplier_panel"], f"""
, w AS (SELECT * FROM sp_agg WHERE n_transactions >= 5
        AND date BETWEEN CAST(DATE '2001-06-01' - INTERVAL 24 MONTH AS DATE) AND DATE '2001-06-01')
SELECT station, date, n_transactions, {rnd('prix_m2', 'prix_m2')} FROM w
WHERE station IN (SELECT station FROM w GROUP BY station HAVING count(*) >= 24)""").replace("\n, w AS", ",\nw AS", 1)

_FP_MEANS = ["prix_m2", "surface", "rooms", "distance_gare_km", "relative_signature", "relative_opening", "taux", "lat_gare", "lon_gare",
             "variation_mom", "variation_yoy", "revenu_median_2021", "evo_population_2016_2022", "part_proprio_2022", "part_hlm_2022",
             "part_cadres_2022", "part_log_vacants_2022", "taux_chomage_2024", "part_eleves_prive_2024", "nb_etablissements_2023"]

Q["feature_panel"] = with_ctes(["enriched", "rates_ym"], f"""
, pf AS (
  SELECT g.sale_id, g.surface, g.rooms, g.prix_m2, g.type_local, g.nature_mutation, s.nom_gare AS station, s.latitude AS lat_gare, s.longitude AS lon_gare,
         CAST(date_trunc('month', g.date_mutation) AS DATE) AS date, a.distance_gp_km AS distance_gare_km,
         year(g.date_mutation) - year(s.date_signature) AS relative_signature, year(g.date_mutation) - year(s.date_ouverture) AS relative_opening,
         r.taux, r.variation_mom, r.variation_yoy, i.*
  FROM geo_rows g LEFT JOIN near_gp a ON g.rid = a.rid LEFT JOIN stations_prep s ON a.station_id = s.station_id
  LEFT JOIN rates_ym r ON g.annee = r.annee AND g.mois = r.mois LEFT JOIN indicators_dedup i ON g.code_ville = i.code_ville),
fp AS (
  SELECT station, date, count(*) AS n_transactions, {", ".join(f"{favg(c)} AS {c}" for c in _FP_MEANS)},
         sum(CASE WHEN type_local = 'Appartement' THEN 1e0 ELSE 0e0 END) / count(*) AS share_appartement,
         sum(CASE WHEN nature_mutation = 'Vente' THEN 1e0 ELSE 0e0 END) / count(*) AS share_vente
  FROM pf WHERE station IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2)
SELECT station, date, n_transactions, {", ".join(rnd(c, c) for c in [*_FP_MEANS, "share_appartement", "share_vente"])}
FROM fp WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _FP_MEANS)}""").replace("\n, pf AS", ",\npf AS", 1)

_SC = ["surface", "rooms", "prix_m2"]


def _scaled_sql(center, scale):
    sel = ", ".join(
        rnd(f"({c} - {center.format(c=c)}) / (CASE WHEN {scale.format(c=c)} IS NULL OR {scale.format(c=c)} = 0 "
            f"THEN 1e0 ELSE {scale.format(c=c)} END)", c) for c in _SC)
    return with_ctes(["sales_clean"], f"SELECT sale_id, {sel} FROM sales_clean")


Q["scale_standard"] = _scaled_sql("(SELECT avg({c}) FROM sales_clean)", "(SELECT stddev_pop({c}) FROM sales_clean)")
Q["scale_robust"] = _scaled_sql("(SELECT quantile_cont({c}, 0.5) FROM sales_clean)",
                                "(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM sales_clean)")
Q["scale_minmax"] = _scaled_sql("(SELECT min({c}) FROM sales_clean)", "(SELECT max({c}) - min({c}) FROM sales_clean)")


def _ordinal(col):
    return (f"coalesce((SELECT CAST(r - 1 AS DOUBLE) FROM (SELECT v, dense_rank() OVER (ORDER BY v) AS r FROM "
            f"(SELECT DISTINCT {col} AS v FROM sales_clean WHERE {col} IS NOT NULL)) m WHERE m.v = t.{col}), -1e0)")


Q["ordinal_encode"] = with_ctes(["sales_typed", "sales_clean"], f"""
SELECT t.sale_id, {_ordinal('type_local')} AS type_local_idx, {_ordinal('nature_mutation')} AS nature_mutation_idx
FROM sales_typed t""")

Q["one_hot"] = with_ctes(["sales_typed"], """
SELECT sale_id,
       CASE WHEN type_local = 'Appartement' THEN 1e0 ELSE 0e0 END AS type_local_Appartement,
       CASE WHEN type_local = 'Local' THEN 1e0 ELSE 0e0 END AS type_local_Local,
       CASE WHEN type_local = 'Maison' THEN 1e0 ELSE 0e0 END AS type_local_Maison
FROM sales_typed""")


def _metrics(pred, name):
    e = f"(prix_m2 - {pred})"
    return (f"SELECT station, {rnd(f'avg(abs({e}))', 'mae')}, round(avg({e} * {e}), 2) AS mse, "
            f"{rnd(f'sqrt(avg({e} * {e}))', 'rmse')}, {rnd(f'avg(abs({e} / prix_m2)) * 100', 'mape')}, "
            f"{rnd(f'1 - sum({e} * {e}) / (var_pop(prix_m2) * count(*))', 'r2')}, count(*) AS n, "
            f"'{name}' AS forecaster FROM j WHERE {pred} IS NOT NULL AND prix_m2 IS NOT NULL GROUP BY station")


Q["regression_metrics"] = with_ctes(["supplier_panel"], f"""
, b AS (SELECT station, date, prix_m2, lag(prix_m2) OVER (PARTITION BY station ORDER BY date) AS pred_last FROM sp_complete),
ya AS (SELECT station, CAST(date + INTERVAL 12 MONTH AS DATE) AS date, prix_m2 AS pred_year_ago FROM sp_complete),
j AS (SELECT b.*, ya.pred_year_ago FROM b LEFT JOIN ya ON b.station = ya.station AND b.date = ya.date)
{_metrics('pred_last', 'last_value')}
UNION ALL
{_metrics('pred_year_ago', 'year_ago')}""").replace("\n, b AS", ",\nb AS", 1)

_DML_X = ["surface", "rooms", "taux", "distance_hist_km"]


def _orthogonal(cols):
    """Rows once per training fold ``tf``, each covariate less its mean and its parts along
    those before it, with coefficients of the rows of that fold: e0, e1, ..."""
    over = "FILTER (f = tf) OVER (PARTITION BY tf)"
    steps = [f"""b AS (
  SELECT row_number() OVER () AS k, order_key % 2 AS f, log_prix_m2 AS y, CAST(d_gp AS DOUBLE) AS d, d_gp, station_id,
         {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(cols))}
  FROM enriched WHERE log_prix_m2 IS NOT NULL AND d_gp IS NOT NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in cols)}),
g AS (SELECT b.*, tf FROM b, (VALUES (0), (1)) AS t(tf)),
c AS (SELECT * REPLACE ({", ".join(f"x{i} - avg(x{i}) {over} AS x{i}" for i in range(len(cols)))}),
        y - avg(y) {over} AS yc, d - avg(d) {over} AS dc FROM g)"""]
    last = "c"
    for i in range(len(cols)):
        parts = "".join(f" - (sum(x{i} * e{j}) {over}) / (sum(e{j} * e{j}) {over}) * e{j}" for j in range(i))
        steps.append(f"o{i} AS (SELECT *, x{i}{parts} AS e{i} FROM {last})")
        last = f"o{i}"
    return ",\n".join(steps)


def _residual(col, over, n=len(_DML_X)):
    return col + "".join(f" - (sum({col} * e{j}) {over}) / (sum(e{j} * e{j}) {over}) * e{j}" for j in range(n))


_DML_B = "\n, " + _orthogonal(_DML_X)
_BY_FOLD = "FILTER (f = tf) OVER (PARTITION BY tf)"
_BY_STATION = "FILTER (f = tf) OVER (PARTITION BY s, tf)"
_LAST = f"o{len(_DML_X) - 1}"

Q["dml_linear"] = with_ctes(["enriched"], _DML_B + f""",
a AS (SELECT f, tf, {_residual('yc', _BY_FOLD)} AS yt, {_residual('dc', _BY_FOLD)} AS dt FROM {_LAST}),
r AS (SELECT yt, dt FROM a WHERE f <> tf),
t AS (SELECT sum(yt * dt) / sum(dt * dt) AS tau, sum(dt * dt) AS sdd, count(*) AS n FROM r),
e AS (SELECT sum((r.yt - t.tau * r.dt) * (r.yt - t.tau * r.dt)) AS rss FROM r, t),
z AS (SELECT tau, sqrt(rss / (n - 1) / sdd) AS se, n FROM t, e)
SELECT {rnd('tau', 'tau_hat')}, {rnd('se', 'se_tau')}, {rnd('tau - 1.96e0 * se', 'ci_low')},
       {rnd('tau + 1.96e0 * se', 'ci_high')}, n, 2 AS n_splits, 'log_prix_m2' AS y_col, 'd_gp' AS d_col
FROM z""").replace("\n\n, b AS", ",\nb AS", 1)

# counts of treated rows come before the null drop
Q["dml_by_station_linear"] = with_ctes(["enriched"], _DML_B + f""",
st AS (SELECT station_id AS s, count(*) AS nt FROM enriched WHERE d_gp = 1 AND station_id IS NOT NULL GROUP BY 1
       HAVING count(*) >= 100 AND count(*) < (SELECT count(*) FROM enriched)),
ay AS (SELECT k, f, tf, {", ".join(f"e{j}" for j in range(len(_DML_X)))}, d_gp, station_id, {_residual('yc', _BY_FOLD)} AS yt FROM {_LAST}),
bs AS (SELECT ay.*, st.s, CASE WHEN d_gp = 1 AND station_id = st.s THEN 1e0 ELSE 0e0 END AS ds FROM ay CROSS JOIN st),
bc AS (SELECT *, ds - avg(ds) {_BY_STATION} AS dsc FROM bs),
a AS (SELECT s, f, tf, yt, {_residual('dsc', _BY_STATION)} AS dt FROM bc),
r AS (SELECT s, yt, dt FROM a WHERE f <> tf),
t AS (SELECT s, sum(yt * dt) / sum(dt * dt) AS tau, sum(dt * dt) AS sdd, sum(yt * yt) AS syy, sum(yt * dt) AS syd, count(*) AS n FROM r GROUP BY s),
z AS (SELECT t.s, t.tau, sqrt((syy - 2 * tau * syd + tau * tau * sdd) / (t.n - 1) / t.sdd) AS se, t.n, st.nt FROM t JOIN st ON st.s = t.s)
SELECT CAST(s AS BIGINT) AS station_id, {rnd('tau', 'tau_hat')}, {rnd('se', 'se_tau')},
       {rnd('tau - 1.96e0 * se', 'ci_low')}, {rnd('tau + 1.96e0 * se', 'ci_high')},
       {rnd('(exp(tau) - 1) * 100', 'ate_pct')}, {rnd('(exp(tau - 1.96e0 * se) - 1) * 100', 'ci_low_pct')},
       {rnd('(exp(tau + 1.96e0 * se) - 1) * 100', 'ci_high_pct')}, n, CAST(nt AS BIGINT) AS n_treated
FROM z""").replace("\n\n, b AS", ",\nb AS", 1)

_COV = ["lon", "lat", "taux", "revenu_median_2021", "station_id"]
Q["coverage_report"] = with_ctes(["enriched"], "\nSELECT " + ", ".join(
    rnd(f"avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)", c) for c in _COV) + ", " + rnd(
    "(" + "(" * len(_COV) + "0e0" + "".join(f" + avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END))" for c in _COV)
    + " / 5e0)", "mean_missing") + " FROM enriched")

Q["station_kind_counts"] = with_ctes(["all_stations"], """
SELECT is_grand_paris, count(*) AS n FROM all_stations GROUP BY is_grand_paris""")

Q["distinct_stations"] = with_ctes(["enriched"], """
SELECT DISTINCT station_id FROM enriched WHERE station_id IS NOT NULL""")

# ---------------------------------------------------------------------------
# Selection, station codes, prediction input, preprocessors
# ---------------------------------------------------------------------------

Q["select_new_within"] = with_ctes(["enriched"], """
SELECT station_id, date, count(*) AS n_transactions FROM enriched WHERE d_gp = 1 AND distance_gp_km <= 2e0
GROUP BY station_id, date HAVING count(*) >= 2""")

Q["select_one_station"] = with_ctes(["sales_typed"], """
SELECT sale_id, station, date FROM sales_typed WHERE station = 14""")

Q["station_codes"] = with_ctes(["supplier_panel"], """
SELECT station, row_number() OVER (ORDER BY min(date), station) - 1 AS gare_id FROM sp_agg GROUP BY station""")

_PF = ["n_transactions", "prix_m2", "rooms", "surface", "discount", "share_appartement", "share_vente"]


_WINDOW_START = "date < DATE '1999-06-01'"


def _unit(col, source, where):
    """Min-max of ``col`` by the rows of ``source``; a constant column has scale 1."""
    low, high = (f"(SELECT {f}({col}) FROM {source} WHERE {where})" for f in ("min", "max"))
    return f"(({col} - {low}) / coalesce(nullif(CAST({high} - {low} AS DOUBLE), 0e0), 1e0))"


Q["prediction_input"] = with_ctes(["supplier_panel"], f"""
, n AS (SELECT * FROM sp_agg WHERE station % 2 = 0 AND n_transactions >= 5),
s AS (SELECT station, date, prix_m2 AS y, {', '.join(f"{_unit(c, 'n', _WINDOW_START)} AS {c}" for c in _PF)} FROM n
      WHERE date BETWEEN DATE '1999-06-01' AND DATE '2001-06-01'),
w AS (SELECT station, date AS origin, count(*) OVER p AS k, lag(n_transactions, 17) OVER o AS x_first, share_vente AS x_last,
        sum({' + '.join(_PF)}) OVER p AS x_sum, lead(y, 1) OVER o AS y1, lead(y, 6) OVER o AS y_end
      FROM s WINDOW o AS (PARTITION BY station ORDER BY date), p AS (PARTITION BY station ORDER BY date ROWS 17 PRECEDING))
SELECT station, origin, CAST(18 * 7 AS INTEGER) AS x_len, {', '.join(rnd(c, c) for c in ['x_first', 'x_last', 'x_sum', 'y1', 'y_end'])}
FROM w WHERE k = 18""").replace("\n, n AS", ",\nn AS", 1)

Q["last_horizon_actuals"] = with_ctes(["supplier_panel"], f"""
SELECT station, date, {rnd('prix_m2', 'prix_m2')} FROM sp_complete WHERE date BETWEEN DATE '2000-12-01' AND DATE '2001-06-01'""")

Q["assemble_frames"] = with_ctes(["sales_typed"], """
SELECT sale_id, CAST(date AS DATE) AS date, CASE WHEN type_local = 'Appartement' THEN rooms END AS rooms,
       CASE WHEN type_local = 'Maison' THEN surface END AS surface
FROM sales_typed WHERE type_local IN ('Appartement', 'Maison')""")

Q["scale_inverse"] = with_ctes(["sales_typed"], f"""
SELECT sale_id, {rnd('surface', 'surface')}, {rnd('rooms', 'rooms')}, round(prix_m2 * surface, 2) AS value FROM sales_typed""")


def _label(col, where):
    """Alphabetical index among the rows of ``where``; -1 for a category not among them."""
    return (f"coalesce((SELECT CAST(r - 1 AS DOUBLE) FROM (SELECT v, dense_rank() OVER (ORDER BY v) AS r FROM "
            f"(SELECT DISTINCT {col} AS v FROM sales_typed WHERE {where})) m WHERE m.v = t.{col}), -1e0)")


def _robust(col, where):
    q = [f"(SELECT quantile_cont({col}, {p}) FROM sales_typed WHERE {where})" for p in (0.25, 0.5, 0.75)]
    return f"(t.{col} - {q[1]}) / coalesce(nullif({q[2]} - {q[0]}, 0e0), 1e0)"


_BEFORE = "date < DATE '2000-01-01'"
Q["preprocess"] = with_ctes(["sales_typed"], f"""
SELECT sale_id, {_label('type_local', _BEFORE)} AS type_local, {_label('nature_mutation', _BEFORE)} AS nature_mutation,
       {rnd(_robust('surface', _BEFORE), 'surface')}, {rnd(_robust('rooms', _BEFORE), 'rooms')},
       {rnd(_unit('prix_m2', 'sales_typed', _BEFORE), 'prix_m2')}
FROM sales_typed t""")

Q["station_inputs"] = with_ctes(["supplier_panel"], f"""
SELECT station, date, {', '.join(rnd(_unit(c, 'sp_complete', _BEFORE), c) for c in _PF)} FROM sp_complete""")

Q["encode_table"] = with_ctes(["sales_typed"], f"""
SELECT sale_id, {rnd(_label('nature_mutation', 'true') + " / greatest((SELECT count(DISTINCT nature_mutation) FROM sales_typed) - 1, 1)", 'nature_mutation')},
       {', '.join(rnd(_unit(c, 'sales_typed', 'true'), c) for c in _SC)},
       {', '.join(f"CASE WHEN type_local = '{v}' THEN 1e0 ELSE 0e0 END AS type_local_{v}" for v in ('Appartement', 'Local', 'Maison'))}
FROM sales_typed t""")

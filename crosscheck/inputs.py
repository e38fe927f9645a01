"""Domain-shaped inputs derived from the driver's tables.

Each input exists twice: as a DataFrame here and as a SQL text of the same name in ``SQL``.
All are plain expressions over whole tables; the SQL twins feed the DuckDB comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emploiscope.operators.grid import DEPARTEMENTS, ROME_CODES

TITLES = [
    "Senior Data Engineer",
    "Développeur Data",
    "Ingénieur de données",
    "Data center engineering operations",
    "Data Engineer / Power BI",
    "Ingénieur data scientist",
    "Architecte data",
    "Business Data Analyst",
    "Consultant BI",
    "PowerBI",
    "BI Developer",
    "MLOps",
    "Ingénieur machine learning",
    "Data Scientist",
    "Ingénieure data",
    "Développeur Java",
    None,
    "Analyste de donnees",
    "DCEO engineer",
    "Ingenieur\tML",
    "Lead BI analyst",
    "data  architect",
    "ébi developer",
]

YEARS = range(1995, 2002)

SURVEY_HEADERS = [
    "annee",
    "Code métier BMO",
    "Nom métier BMO",
    "Famille_met",
    "Lbl_fam_met",
    "REG",
    "NOM_REG",
    "Dept",
    "NomDept",
    "BE25",
    "NOMBE25",
    "met",
    "xmet",
    "smet",
]
SURVEY_CODES = ["M1X80", "M1X81", "M2X90", "M2X91", "M2X92", "M2X93", "V4Z82", "M2X94"]
SECTORS = [
    "62 Programmation, conseil et autres activités informatiques",
    "63 Services d'information",
    "61 Télécommunications",
    "58 Édition",
    "26 Fabrication de produits informatiques",
]
RUN_DATE_SQL = "DATE '2026-03-20'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str | None], index: Column) -> Column:
    return F.get(F.array(*(F.lit(v).cast("string") for v in values)), index.cast("int"))


def sql_list(values: list[str | None]) -> str:
    quoted = ("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return "[" + ", ".join(quoted) + "]"


def text(column: Column) -> Column:
    return column.cast("string")


def padded(column: Column, width: int) -> Column:
    return F.lpad(text(column), width, "0")


def adzuna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw Adzuna snapshots from orders: one offer per customer, seen on each order date."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "*",
        "o_orderkey % 9 AS salary",
        "o_custkey % 28 AS place",
        "get(array('NATION_', 'nation_', 'Nâtion_'), cast(o_orderkey % 3 AS int)) || o_custkey % 28 AS dept",
        "double(floor(o_totalprice / 4)) AS quarter",
        "double(floor(o_totalprice / 2)) AS half",
    )
    return orders.select(pick(TITLES, F.col("o_orderkey") % len(TITLES)).alias("titre"), "*").selectExpr(
        "string(o_custkey) AS offre_id",
        "titre",
        "o_orderstatus || ' ' || o_orderpriority AS description",
        "timestamp(o_orderdate) + (o_orderkey % 86400) * interval 1 second AS date_creation",
        "CASE WHEN o_orderkey % 11 <> 0 THEN 'Entreprise ' || o_orderkey % 97 END AS entreprise_nom",
        "CASE WHEN o_orderkey % 101 <> 0 THEN dept END AS localisation_libelle",
        "CASE WHEN o_orderkey % 4 <> 0 THEN slice(array('France', 'Région ' || place % 5, dept), 1, int(o_orderkey % 4)) END"
        " AS localisation_area",
        "o_totalprice / 10000 AS latitude",
        "o_totalprice / 20000 AS longitude",
        "CASE WHEN salary IN (1, 8) THEN quarter WHEN salary = 3 THEN double(floor(o_totalprice / 100))"
        " WHEN salary = 4 THEN 14999.5D WHEN salary = 5 THEN 0D WHEN salary = 6 THEN 2000D WHEN salary = 7 THEN half END"
        " AS salaire_min",
        "CASE WHEN salary = 1 THEN quarter + 5000 WHEN salary = 2 THEN quarter WHEN salary = 5 THEN 50000D"
        " WHEN salary = 6 THEN 40000D WHEN salary = 7 THEN half + 10000 END AS salaire_max",
        "o_orderkey % 2 AS salaire_est_estime",
        "CASE WHEN o_orderkey % 5 <> 0 THEN 'permanent' END AS type_contrat",
        "CASE WHEN o_orderkey % 7 <> 0 THEN 'full_time' END AS temps_travail",
        "'it-jobs' AS categorie_tag",
        "o_orderpriority AS categorie_libelle",
        "'https://offres.example/' || o_orderkey AS redirect_url",
        "date(o_orderdate) AS _ingestion_date",
    )


def france_travail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw France Travail snapshots from events; only the nested fields staging reads are filled."""
    key, user = F.col("event_id"), F.col("user_id")
    base, kind = text(30000 + (key % 100) * 500), key % 10
    spaced = F.concat(text(30 + key % 40), F.lit(" 500,00"))
    libelle = (
        F.when(kind == 0, F.concat(F.lit("Annuel de "), base, F.lit(".0 Euros à "), base, F.lit("9.0 Euros sur 12.0 mois")))
        .when(kind == 1, F.concat(F.lit("Mensuel de 2500.0 Euros à "), base, F.lit(".0 Euros sur 13.0 mois")))
        .when(kind == 2, F.concat(F.lit("Horaire de "), text(key % 40 + 12), F.lit(",5 Euros")))
        .when(kind == 3, F.concat(F.lit("Annuel de "), base, F.lit(".0 Euros")))
        .when(kind == 4, F.lit("A négocier"))
        .when(kind == 5, F.concat(F.lit("Mensuel de 2 500,00 Euros à "), F.translate(F.lit("3 200,00 Euros"), " ", "\u00a0")))
        .when(kind == 6, F.concat(F.lit("Annuel de "), spaced, F.lit(" Euros")))
        .when(kind == 7, F.concat(F.lit("Annuel de "), base, F.lit(".0 à 95000.0 Euros")))
        .when(kind == 8, F.lit("Annuel selon profil, 13 mois"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("FT"), text(key % 4000)).alias("id"),
        F.col("ts").cast("timestamp").alias("dateCreation"),
        pick(TITLES, key % len(TITLES)).alias("intitule"),
        F.col("props").alias("description"),
        pick([*ROME_CODES, "M1899"], key % 5).alias("romeCode"),
        F.when(key % 3 == 0, "CDI").otherwise("CDD").alias("typeContrat"),
        F.lit("Temps plein").alias("dureeTravailLibelleConverti"),
        F.struct(
            F.when(key % 26 == 0, F.concat(padded(key % 25, 2), F.lit(" - Ville"))).otherwise(F.concat(F.lit("Lieu "), text(user))).alias("libelle"),
            F.when(key % 13 != 0, F.when(key % 17 == 0, text(75101 + user % 20)).otherwise(text(75000 + user * 20))).alias("commune"),
            text(75000 + user).alias("codePostal"),
            F.col("value").alias("latitude"),
            (F.col("value") * 2).alias("longitude"),
        ).alias("lieuTravail"),
        F.struct(F.when(key % 4 != 0, F.concat(F.lit("Entreprise "), text(user % 97))).alias("nom")).alias("entreprise"),
        F.struct(libelle.alias("libelle")).alias("salaire"),
        F.col("ts").cast("date").alias("_ingestion_date"),
    )


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched offers with their grid cell, from events; two cells lie outside the grid."""
    places = [*DEPARTEMENTS, "975", "00"]
    return table(spark, sf_dir, "events").select(
        text(F.col("user_id")).alias("id"),
        pick([*ROME_CODES, "M1899"], F.col("event_id") % 5).alias("rome"),
        pick(places, F.col("user_id") % len(places)).alias("departement"),
        F.col("event_id").alias("sequence"),
    )


def hot_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with most rows in one cell per job code."""
    user = F.col("user_id") % 7
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("rome"),
        F.when(user == 5, "2A").when(user == 6, "971").otherwise("75").alias("departement"),
        F.col("event_id").alias("sequence"),
        "value",
    )


def geo_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("nom"),
        text(key + 10).alias("code"),
        F.when(key < 3, "metro").when(key == 3, "drom").otherwise("outremer").alias("zone"),
    )


def geo_departements(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("nom"),
        padded(key, 2).alias("code"),
        F.when(key % 9 == 8, "99").otherwise(text(F.col("n_regionkey") + 10)).alias("codeRegion"),
        F.when(key < 20, "metro").otherwise("drom").alias("zone"),
    )


def geo_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communes from customers; some lie in a territory or département without a parent row."""
    key, nation, balance = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    point = F.struct(F.lit("Point").alias("type"), F.array(balance / 100, balance / 50).alias("coordinates"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("nom"),
        text(key + 75000).alias("code"),
        F.when(key % 50 == 0, "975").when(key % 41 == 0, "88").when(key % 43 != 0, padded(nation, 2)).alias("codeDepartement"),
        F.when(key % 50 == 0, "975").otherwise(text(nation % 6 + 10)).alias("codeRegion"),
        F.array(text(key + 75000)).alias("codesPostaux"),
        F.when(key % 29 != 0, F.floor(balance) * 10).cast("bigint").alias("population"),
        F.when(key % 31 != 0, point).alias("centre"),
    )


def sirene(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        padded(key, 14).alias("siret"),
        padded(F.floor(key / 3), 9).alias("siren"),
        F.when(key % 5 == 0, F.col("c_name")).alias("denominationUsuelleEtablissement"),
        F.when(key % 6 == 0, F.col("c_mktsegment")).alias("enseigne1Etablissement"),
        F.when(key % 37 != 0, "62.01Z").alias("activitePrincipaleEtablissement"),
        F.when(key % 2 == 0, "NN").otherwise("11").alias("trancheEffectifsEtablissement"),
        F.when(key % 47 != 0, text(key + 75000)).alias("codeCommuneEtablissement"),
        text(key + 75000).alias("codePostalEtablissement"),
        F.col("c_name").alias("libelleCommuneEtablissement"),
        F.when(key % 17 != 0, F.when(key % 4 == 3, "F").otherwise("A")).alias("etatAdministratifEtablissement"),
        F.when(key % 19 != 0, F.when(key % 3 == 0, "P").otherwise("O")).alias("statutDiffusionEtablissement"),
        F.when(key % 23 != 0, F.when(key % 2 == 0, "O").otherwise("N")).alias("caractereEmployeurEtablissement"),
        F.date_add(F.lit("2000-01-01").cast("date"), (key % 5000).cast("int")).alias("dateCreationEtablissement"),
        (key % 3 == 0).alias("etablissementSiege"),
    )


def urssaf_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide headcounts from lineitem: a row per supplier and return flag, two columns per year."""
    supplier, flag, year = F.col("l_suppkey"), F.col("l_returnflag"), F.year("l_shipdate")
    measures = []
    for y in YEARS:
        heads = F.sum(F.when(year == y, F.col("l_quantity"))).cast("bigint")
        sites = F.count(F.when(year == y, 1))
        measures.append(F.when(supplier % 7 != y % 7, heads).alias(f"effectifs_salaries_{y}"))
        measures.append(F.when(supplier % 5 != y % 5, sites).alias(f"nombre_d_etablissements_{y}"))
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(*measures)
    # Arrondissements of the three cities among the communes; the code begins with the département.
    plain = F.concat(padded(supplier % 25, 2), padded(supplier % 1000, 3))
    code = (
        F.when(supplier % 25 == 3, text(75101 + supplier % 20))
        .when(supplier % 25 == 4, text(69381 + supplier % 9))
        .when(supplier % 25 == 5, text(13201 + supplier % 16))
        .otherwise(plain)
    )
    ape = F.when(supplier % 10 == 9, "7022Z").when(flag == "A", "6201Z").when(flag == "N", "6202A").otherwise("6203Z")
    return grouped.select(
        code.alias("code_commune"),
        F.concat(code, F.lit(" Commune")).alias("intitule_commune"),
        F.substring(code, 1, 2).alias("code_departement"),
        ape.alias("code_ape"),
        *(c for c in grouped.columns if c[-4:].isdigit()),
    )


def bmo_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hiring survey as text from part and lineitem, small counts masked.

    Line items are counted per part and year before parts join, so a frequent part is one
    row per year in the join.
    """
    lines = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    per_part = lines.groupBy("l_partkey", F.year("l_shipdate").alias("y")).agg(
        F.count("*").alias("n"), F.count_if(flag == "A").alias("n_a"), F.count_if(flag == "R").alias("n_r")
    )
    part, size = F.col("p_partkey"), F.col("p_size")
    keyed = per_part.join(table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("l_partkey") == part)
    grouped = keyed.groupBy(
        "y", (size % 8).alias("job"), (part % 27).alias("dept"), (F.floor(part / 27) % 3).alias("zone")
    ).agg(F.sum("n").alias("n"), F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))

    def masked(name: str, least: int) -> Column:
        return F.when(F.col(name) < least, "*").otherwise(text(F.col(name)))

    values = [
        text(F.col("y")),
        pick(SURVEY_CODES, F.col("job")),
        F.concat(F.lit("Métier "), text(F.col("job"))),
        F.when(F.col("job") < 2, "A").otherwise("C"),
        F.concat(F.lit("Famille "), text(F.col("job"))),
        text(F.col("dept") % 5 + 10),
        F.concat(F.lit("Région "), text(F.col("dept") % 5)),
        padded(F.col("dept"), 2),
        F.concat(F.lit("NATION_"), text(F.col("dept"))),
        F.concat(padded(F.col("dept"), 2), text(F.col("zone"))),
        F.concat(F.lit("Bassin "), text(F.col("zone"))),
        masked("n", 12),
        masked("n_a", 4),
        masked("n_r", 6),
    ]
    return grouped.select(*(value.alias(name) for name, value in zip(SURVEY_HEADERS, values, strict=True)))


def payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll records from orders: a row per year and priority, one priority being sector 62."""
    grouped = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("y"), (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("sector"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("o_custkey") % 50).alias("heads"),
            F.sum(F.floor("o_totalprice")).alias("price"),
        )
    )
    return grouped.select(
        text(F.col("y")).alias("annee"),
        pick(SECTORS, F.col("sector")).alias("secteur_na88i"),
        F.col("n").alias("nombre_d_etablissements"),
        F.col("heads").alias("effectifs_salaries_moyens"),
        (F.col("price") * 1000).cast("bigint").alias("masse_salariale"),
    )


_COMMUNE = """(CASE l_suppkey % 25 WHEN 3 THEN CAST(75101 + l_suppkey % 20 AS VARCHAR) WHEN 4 THEN CAST(69381 + l_suppkey % 9 AS VARCHAR)
        WHEN 5 THEN CAST(13201 + l_suppkey % 16 AS VARCHAR)
        ELSE lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') || lpad(CAST(l_suppkey % 1000 AS VARCHAR), 3, '0') END)"""

# The same inputs as SQL, in dependency order.
SQL: dict[str, str] = {
    "adzuna": f"""
SELECT CAST(o_custkey AS VARCHAR) AS offre_id,
       ({sql_list(TITLES)})[1 + o_orderkey % {len(TITLES)}] AS titre,
       o_orderstatus || ' ' || o_orderpriority AS description,
       o_orderdate + to_seconds(o_orderkey % 86400) AS date_creation,
       CASE WHEN o_orderkey % 11 <> 0 THEN 'Entreprise ' || (o_orderkey % 97) END AS entreprise_nom,
       CASE WHEN o_orderkey % 101 <> 0 THEN dept END AS localisation_libelle,
       CASE WHEN o_orderkey % 4 <> 0
            THEN (['France', 'Région ' || (o_custkey % 28 % 5), dept])[1:o_orderkey % 4] END AS localisation_area,
       o_totalprice / 10000 AS latitude,
       o_totalprice / 20000 AS longitude,
       CASE WHEN o_orderkey % 9 IN (1, 8) THEN floor(o_totalprice / 4)
            WHEN o_orderkey % 9 = 3 THEN floor(o_totalprice / 100)
            WHEN o_orderkey % 9 = 4 THEN CAST(14999.5 AS DOUBLE)
            WHEN o_orderkey % 9 = 5 THEN 0
            WHEN o_orderkey % 9 = 6 THEN 2000
            WHEN o_orderkey % 9 = 7 THEN floor(o_totalprice / 2) END AS salaire_min,
       CASE WHEN o_orderkey % 9 = 1 THEN floor(o_totalprice / 4) + 5000
            WHEN o_orderkey % 9 = 2 THEN floor(o_totalprice / 4)
            WHEN o_orderkey % 9 = 5 THEN 50000
            WHEN o_orderkey % 9 = 6 THEN 40000
            WHEN o_orderkey % 9 = 7 THEN floor(o_totalprice / 2) + 10000 END AS salaire_max,
       o_orderkey % 2 AS salaire_est_estime,
       CASE WHEN o_orderkey % 5 <> 0 THEN 'permanent' END AS type_contrat,
       CASE WHEN o_orderkey % 7 <> 0 THEN 'full_time' END AS temps_travail,
       'it-jobs' AS categorie_tag,
       o_orderpriority AS categorie_libelle,
       'https://offres.example/' || o_orderkey AS redirect_url,
       CAST(o_orderdate AS DATE) AS _ingestion_date
FROM (SELECT *, (['NATION_', 'nation_', 'Nâtion_'])[1 + o_orderkey % 3] || (o_custkey % 28) AS dept FROM orders)""",
    "france_travail": f"""
SELECT event_id, 'FT' || (event_id % 4000) AS id,
       ts AS dateCreation,
       ({sql_list(TITLES)})[1 + event_id % {len(TITLES)}] AS intitule,
       props AS description,
       ({sql_list([*ROME_CODES, "M1899"])})[1 + event_id % 5] AS romeCode,
       CASE WHEN event_id % 3 = 0 THEN 'CDI' ELSE 'CDD' END AS typeContrat,
       'Temps plein' AS dureeTravailLibelleConverti,
       CASE WHEN event_id % 26 = 0 THEN lpad(CAST(event_id % 25 AS VARCHAR), 2, '0') || ' - Ville' ELSE 'Lieu ' || user_id END AS lieu,
       CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_id % 17 = 0 THEN CAST(75101 + user_id % 20 AS VARCHAR)
            ELSE CAST(75000 + user_id * 20 AS VARCHAR) END END AS commune,
       CAST(75000 + user_id AS VARCHAR) AS code_postal,
       value AS latitude,
       value * 2 AS longitude,
       CASE WHEN event_id % 4 <> 0 THEN 'Entreprise ' || (user_id % 97) END AS entreprise_nom,
       CASE event_id % 10
            WHEN 0 THEN 'Annuel de ' || base || '.0 Euros à ' || base || '9.0 Euros sur 12.0 mois'
            WHEN 1 THEN 'Mensuel de 2500.0 Euros à ' || base || '.0 Euros sur 13.0 mois'
            WHEN 2 THEN 'Horaire de ' || (event_id % 40 + 12) || ',5 Euros'
            WHEN 3 THEN 'Annuel de ' || base || '.0 Euros'
            WHEN 4 THEN 'A négocier'
            WHEN 5 THEN 'Mensuel de 2 500,00 Euros à ' || replace('3 200,00 Euros', ' ', chr(160))
            WHEN 6 THEN 'Annuel de ' || (30 + event_id % 40) || ' 500,00 Euros'
            WHEN 7 THEN 'Annuel de ' || base || '.0 à 95000.0 Euros'
            WHEN 8 THEN 'Annuel selon profil, 13 mois' END AS salaire_libelle,
       CAST(ts AS DATE) AS _ingestion_date
FROM (SELECT *, CAST(30000 + (event_id % 100) * 500 AS VARCHAR) AS base FROM events)""",
    "fetches": f"""
SELECT CAST(user_id AS VARCHAR) AS id,
       ({sql_list([*ROME_CODES, "M1899"])})[1 + event_id % 5] AS rome,
       ({sql_list([*DEPARTEMENTS, "975", "00"])})[1 + user_id % {len(DEPARTEMENTS) + 2}] AS departement,
       event_id AS sequence
FROM events""",
    "hot_fetches": """
SELECT event_type AS rome,
       CASE user_id % 7 WHEN 5 THEN '2A' WHEN 6 THEN '971' ELSE '75' END AS departement,
       event_id AS sequence, value
FROM events""",
    "geo_regions": """
SELECT r_name AS nom, CAST(r_regionkey + 10 AS VARCHAR) AS code,
       CASE WHEN r_regionkey < 3 THEN 'metro' WHEN r_regionkey = 3 THEN 'drom' ELSE 'outremer' END AS zone
FROM region""",
    "geo_departements": """
SELECT n_name AS nom, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code,
       CASE WHEN n_nationkey % 9 = 8 THEN '99' ELSE CAST(n_regionkey + 10 AS VARCHAR) END AS codeRegion,
       CASE WHEN n_nationkey < 20 THEN 'metro' ELSE 'drom' END AS zone
FROM nation""",
    "geo_communes": """
SELECT c_name AS nom, CAST(c_custkey + 75000 AS VARCHAR) AS code,
       CASE WHEN c_custkey % 50 = 0 THEN '975' WHEN c_custkey % 41 = 0 THEN '88'
            WHEN c_custkey % 43 <> 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS codeDepartement,
       CASE WHEN c_custkey % 50 = 0 THEN '975' ELSE CAST(c_nationkey % 6 + 10 AS VARCHAR) END AS codeRegion,
       CASE WHEN c_custkey % 29 <> 0 THEN CAST(floor(c_acctbal) * 10 AS BIGINT) END AS population,
       CASE WHEN c_custkey % 31 <> 0 THEN [c_acctbal / 100, c_acctbal / 50] END AS coordinates
FROM customer""",
    "sirene": """
SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret,
       lpad(CAST(c_custkey // 3 AS VARCHAR), 9, '0') AS siren,
       CASE WHEN c_custkey % 5 = 0 THEN c_name END AS denomination,
       CASE WHEN c_custkey % 6 = 0 THEN c_mktsegment END AS enseigne,
       CASE WHEN c_custkey % 37 <> 0 THEN '62.01Z' END AS naf,
       CASE WHEN c_custkey % 2 = 0 THEN 'NN' ELSE '11' END AS tranche,
       CASE WHEN c_custkey % 47 <> 0 THEN CAST(c_custkey + 75000 AS VARCHAR) END AS commune,
       CAST(c_custkey + 75000 AS VARCHAR) AS postal,
       c_name AS libelle,
       CASE WHEN c_custkey % 17 <> 0 THEN CASE WHEN c_custkey % 4 = 3 THEN 'F' ELSE 'A' END END AS etat,
       CASE WHEN c_custkey % 19 <> 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 'P' ELSE 'O' END END AS diffusion,
       CASE WHEN c_custkey % 23 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'O' ELSE 'N' END END AS employeur,
       DATE '2000-01-01' + CAST(c_custkey % 5000 AS INTEGER) AS creation,
       c_custkey % 3 = 0 AS siege
FROM customer""",
    "urssaf_wide": f"""
SELECT {_COMMUNE} AS code_commune, {_COMMUNE} || ' Commune' AS intitule_commune, left({_COMMUNE}, 2) AS code_departement,
       CASE WHEN l_suppkey % 10 = 9 THEN '7022Z' WHEN l_returnflag = 'A' THEN '6201Z'
            WHEN l_returnflag = 'N' THEN '6202A' ELSE '6203Z' END AS code_ape,
       {", ".join(
           f"CASE WHEN l_suppkey % 7 <> {y % 7} THEN CAST(sum(l_quantity) FILTER (year(l_shipdate) = {y}) AS BIGINT) END"
           f" AS effectifs_salaries_{y}, CASE WHEN l_suppkey % 5 <> {y % 5}"
           f" THEN count(*) FILTER (year(l_shipdate) = {y}) END AS nombre_d_etablissements_{y}"
           for y in YEARS)}
FROM lineitem GROUP BY l_suppkey, l_returnflag""",
    "bmo_survey": f"""
SELECT CAST(y AS VARCHAR) AS annee,
       ({sql_list(SURVEY_CODES)})[1 + job] AS "Code métier BMO",
       'Métier ' || job AS "Nom métier BMO",
       CASE WHEN job < 2 THEN 'A' ELSE 'C' END AS "Famille_met",
       'Famille ' || job AS "Lbl_fam_met",
       CAST(dept % 5 + 10 AS VARCHAR) AS "REG",
       'Région ' || (dept % 5) AS "NOM_REG",
       lpad(CAST(dept AS VARCHAR), 2, '0') AS "Dept",
       'NATION_' || dept AS "NomDept",
       lpad(CAST(dept AS VARCHAR), 2, '0') || zone AS "BE25",
       'Bassin ' || zone AS "NOMBE25",
       CASE WHEN n < 12 THEN '*' ELSE CAST(n AS VARCHAR) END AS met,
       CASE WHEN n_a < 4 THEN '*' ELSE CAST(n_a AS VARCHAR) END AS xmet,
       CASE WHEN n_r < 6 THEN '*' ELSE CAST(n_r AS VARCHAR) END AS smet
FROM (SELECT year(l_shipdate) AS y, p_size % 8 AS job, p_partkey % 27 AS dept, p_partkey // 27 % 3 AS zone,
             count(*) AS n, count(*) FILTER (l_returnflag = 'A') AS n_a, count(*) FILTER (l_returnflag = 'R') AS n_r
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)""",
    "payroll": f"""
SELECT CAST(year(o_orderdate) AS VARCHAR) AS annee,
       ({sql_list(SECTORS)})[CAST(o_orderpriority[1] AS INTEGER)] AS secteur_na88i,
       count(*) AS nombre_d_etablissements,
       CAST(sum(o_custkey % 50) AS BIGINT) AS effectifs_salaries_moyens,
       CAST(sum(floor(o_totalprice)) * 1000 AS BIGINT) AS masse_salariale
FROM orders GROUP BY ALL""",
}

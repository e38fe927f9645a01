import datetime
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emploiscope import schemas
from emploiscope.operators.quality import CheckFailed
from emploiscope.plans import intermediate, layers, marts
from emploiscope.plans import staging_offers as offers
from emploiscope.plans import staging_territory as territory

DAY = datetime.date(2026, 3, 20)
LATER = datetime.date(2026, 3, 27)


def frame(spark, schema, *records):
    """Rows of ``schema`` from partial dicts; absent fields are NULL."""
    return spark.createDataFrame([{**dict.fromkeys(schema.fieldNames()), **r} for r in records], schema)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def adzuna(spark):
    area = ["France", "Île-de-France", "Val-d'Oise"]
    return frame(
        spark,
        schemas.ADZUNA,
        {"offre_id": "1", "titre": "Data Analyst", "salaire_min": 2000.0, "_ingestion_date": DAY},
        {"offre_id": "1", "titre": "Data Engineer", "salaire_min": 45000.0, "salaire_max": 55000.0, "localisation_area": area,
         "entreprise_nom": "Acme", "date_creation": datetime.datetime(2026, 3, 20, 8), "_ingestion_date": LATER},
        {"offre_id": "2", "titre": "Développeur Java", "localisation_area": ["France", "Bretagne"], "_ingestion_date": DAY},
        {"offre_id": "3", "titre": "MLOps", "salaire_max": 3000.0, "localisation_area": [], "entreprise_nom": "Acme",
         "_ingestion_date": DAY},
    )


def test_stg_adzuna(spark):
    staged = offers.stg_adzuna__offres(adzuna(spark))
    assert staged.columns == offers.ADZUNA_COLUMNS and len(staged.columns) == 27
    columns = ["offre_id", "categorie_metier", "region", "departement_nom", "source_salaire", "salaire_annuel_min", "salaire_annuel_max"]
    assert rows(staged, *columns) == [
        ("1", "data_engineer", "Île-de-France", "Val-d'Oise", "declare", 45000.0, 55000.0),
        ("2", "autre_it", "Bretagne", None, None, None, None),
        ("3", "ml_engineer", None, None, "declare", None, 36000.0),
    ]
    types = dict(staged.dtypes)
    assert types["salaire_est_estime"] == "bigint" and types["latitude"] == "double" and types["source"] == "string"


def test_titles_are_classified_once(spark, plan):
    staged = offers.stg_adzuna__offres(adzuna(spark))
    assert staged._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 6
    assert "Python" not in plan(staged)


def france_travail(spark):
    def offer(**fields):
        return {"_ingestion_date": DAY, **fields}

    return frame(
        spark,
        schemas.FRANCE_TRAVAIL,
        offer(id="A", intitule="Data Engineer", salaire=("Annuel de 40000.0 Euros", None, None, None, None),
              lieuTravail=("Paris 8", "75108", "75008", 48.8, 2.3), entreprise=("Acme", None, None, None, None)),
        offer(id="B", intitule="Data Scientist", salaire=("Mensuel de 3000.0 Euros à 4000.0 Euros sur 13.0 mois",) + (None,) * 4),
        offer(id="B", intitule="Data Scientist H/F", _ingestion_date=LATER),
        offer(id="C", intitule="Chef de projet"),
    )


def test_stg_france_travail(spark):
    staged = offers.stg_france_travail__offres(france_travail(spark))
    columns = ["offre_id", "titre", "categorie_metier", "salaire_periodicite", "salaire_annuel_min", "salaire_annuel_max", "code_commune"]
    assert rows(staged, *columns) == [
        ("A", "Data Engineer", "data_engineer", "annuel", 40000.0, 40000.0, "75108"),
        ("B", "Data Scientist H/F", "data_scientist", None, None, None, None),
        ("C", "Chef de projet", "autre_it", None, None, None, None),
    ]


def geography(spark):
    regions = territory.stg_geo__regions(
        frame(spark, schemas.GEO_REGIONS, {"code": "11", "nom": "Île-de-France", "zone": "metro"})
    )
    departements = territory.stg_geo__departements(
        frame(
            spark,
            schemas.GEO_DEPARTEMENTS,
            {"code": "75", "nom": "Paris", "codeRegion": "11", "zone": "metro"},
            {"code": "95", "nom": "Val-d’Oise", "codeRegion": "11", "zone": "metro"},
            {"code": "2A", "nom": "Corse-du-Sud", "codeRegion": "94", "zone": "metro"},
        ),
        regions,
    )
    communes = territory.stg_geo__communes(
        frame(
            spark,
            schemas.GEO_COMMUNES,
            {"code": "75056", "nom": "Paris", "codeDepartement": "75", "codeRegion": "11", "centre": ("Point", [2.35, 48.86])},
            {"code": "97502", "nom": "Saint-Pierre", "codeDepartement": "975", "codeRegion": "975"},
        ),
        departements,
        regions,
    )
    return regions, departements, communes


def test_geography_keeps_orphans(spark):
    _, departements, communes = geography(spark)
    assert rows(departements, "code", "nom_region") == [("2A", None), ("75", "Île-de-France"), ("95", "Île-de-France")]
    assert rows(communes, "code", "nom_departement", "nom_region", "centre_lat", "centre_lon") == [
        ("75056", "Paris", "Île-de-France", 48.86, 2.35),
        ("97502", None, None, None, None),
    ]


def test_a_short_point_is_an_error(spark):
    regions, departements, _ = geography(spark)
    raw = frame(spark, schemas.GEO_COMMUNES, {"code": "1", "centre": ("Point", [2.35])})
    with pytest.raises(PySparkException, match="INVALID_ARRAY_INDEX"):
        territory.stg_geo__communes(raw, departements, regions).collect()


def test_stg_bmo(spark):
    raw = frame(
        spark,
        schemas.BMO,
        {"annee": 2025, "projets_recrutement": 2824, "projets_difficiles": 1158},
        {"annee": 2025, "projets_recrutement": None, "projets_difficiles": 1},
        {"annee": 2025, "projets_recrutement": 0, "projets_difficiles": 0},
    )
    assert rows(territory.stg_bmo__projets_recrutement(raw), "part_difficile_pct") == [(41.0,), (None,), (None,)]


def test_stg_urssaf_and_density(spark):
    raw = frame(
        spark,
        schemas.URSSAF_EFFECTIFS,
        {"code_commune": "75101", "code_departement": "75", "code_ape": "6201Z", "annee": 2023, "effectifs_salaries": 5},
        {"code_commune": "75120", "code_departement": "75", "code_ape": "6202A", "annee": 2023, "nb_etablissements": 2},
        {"code_commune": "69383", "code_departement": "69", "code_ape": "6202A", "annee": 2023, "nb_etablissements": 1},
    )
    staged = territory.stg_urssaf__effectifs_commune_ape(raw)
    assert "_ingestion_date" not in staged.columns
    assert rows(staged, "nb_etablissements", "effectifs_salaries") == [(0, 5), (1, 0), (2, 0)]
    density = intermediate.int_densite_sectorielle_commune(staged)
    assert rows(density, "code_commune", "nb_etablissements", "effectifs_salaries") == [("69123", 1, 0), ("75056", 2, 5)]


def test_stg_sirene(spark, tmp_path, plan):
    schema = (
        "siret string, siren string, denominationUsuelleEtablissement string, enseigne1Etablissement string, "
        "activitePrincipaleEtablissement string, trancheEffectifsEtablissement string, codeCommuneEtablissement string, "
        "codePostalEtablissement string, libelleCommuneEtablissement string, etatAdministratifEtablissement string, "
        "statutDiffusionEtablissement string, caractereEmployeurEtablissement string, dateCreationEtablissement date, "
        "etablissementSiege boolean, notUsed string"
    )
    base = ("s", None, None, "62.01Z", "NN", "59350", "59000", "Lille")
    data = [
        ("1", *base, "A", "P", "O", DAY, True, "x"),
        ("2", *base, "F", "O", "N", DAY, True, "x"),
        ("3", *base, "A", "O", None, DAY, False, "x"),
    ]
    path = str(tmp_path / "sirene.parquet")
    spark.createDataFrame(data, schema).write.parquet(path)
    staged = territory.stg_sirene__etablissements(spark.read.parquet(path))
    assert len(staged.columns) == 13
    assert rows(staged, "siret", "is_siege", "is_diffusion_partielle", "is_employeur") == [
        ("1", True, True, True),
        ("3", False, False, None),
    ]
    text = plan(staged)
    assert "EqualTo(etatAdministratifEtablissement,A)" in text and "notUsed" not in text.split("ReadSchema")[-1]


def test_tension_rate_ignores_half_masked_rows(spark):
    data = [("75", 2025, 100, 50), ("75", 2025, 900, None), ("75", 2025, None, 7), ("2A", 2025, None, None)]
    staged = spark.createDataFrame(
        data, "code_departement string, annee bigint, projets_recrutement bigint, projets_difficiles bigint"
    )
    got = intermediate.int_tensions_bassin_emploi(staged)
    assert rows(got, "code_departement", "projets_recrutement", "projets_difficiles", "taux_difficulte_pct") == [
        ("2A", None, None, None),
        ("75", 1000, 57, 50.0),
    ]


def test_offers_are_placed_by_code_or_name(spark):
    _, departements, communes = geography(spark)
    enriched = intermediate.int_offres_enrichies(
        offers.stg_adzuna__offres(adzuna(spark)), offers.stg_france_travail__offres(france_travail(spark)), communes, departements
    )
    assert rows(enriched, "source", "offre_id", "code_commune", "code_departement", "nom_region") == sorted(
        [
            ("adzuna", "1", None, "95", "Île-de-France"),
            ("adzuna", "3", None, None, None),
            ("france_travail", "A", "75056", "75", "Île-de-France"),
            ("france_travail", "B", None, None, None),
        ],
        key=repr,
    )
    assert rows(intermediate.unplaced_offers(enriched), "source", "n_offres", "n_sans_departement") == [
        ("adzuna", 2, 1),
        ("france_travail", 2, 1),
    ]


def test_territory_mart_keeps_both_sides(spark):
    density = spark.createDataFrame(
        [("75056", "75", 2023, 2, 5), ("75057", "75", 2023, 1, 1)],
        "code_commune string, code_departement string, annee bigint, nb_etablissements bigint, effectifs_salaries bigint",
    )
    tension = spark.createDataFrame(
        [("2A", 2024, 10, 5, 50.0)],
        "code_departement string, annee bigint, projets_recrutement bigint, projets_difficiles bigint, taux_difficulte_pct double",
    )
    payroll = spark.createDataFrame(
        [(2023, 24000000000, 480000), (2024, 1, 0)], "annee bigint, masse_salariale_brute bigint, effectifs_salaries_moyens bigint"
    )
    mart = marts.mart_contexte_territorial(density, tension, payroll)
    columns = ["code_departement", "annee", "nb_communes", "effectifs_salaries", "taux_difficulte_pct", "salaire_moyen_national"]
    assert rows(mart, *columns) == [("2A", 2024, None, None, 50.0, None), ("75", 2023, 2, 6, None, 50000.0)]


def mart(spark):
    data = [
        ("Nord", "A", 10.0), ("Nord", "A", 20.0), ("Nord", "B", 60.0), ("Nord", "C", None), ("Nord", None, 40.0),
        (None, "A", None), ("Sud", None, None),
    ]
    return spark.createDataFrame(data, "nom_region string, entreprise_nom string, salaire_annuel_milieu double")


def test_region_summary(spark):
    assert rows(marts.region_summary(mart(spark)), "nom_region", "n_offres", "n_entreprises", "salaire_annuel_median") == sorted(
        [("Nord", 5, 3, 30.0), (None, 1, 1, None), ("Sud", 1, 0, None)], key=repr
    )


def test_top_companies(spark):
    assert rows(marts.top_companies(mart(spark), 2), "nom_region", "entreprise_nom", "n_offres") == sorted(
        [("Nord", "A", 2), ("Nord", "B", 1), (None, "A", 1)], key=repr
    )


def test_mart_offres_month_and_middle(spark):
    df = spark.createDataFrame(
        [(10.0, 20.0, datetime.datetime(2026, 3, 20, 5)), (None, 20.0, None), (None, None, None)],
        "salaire_annuel_min double, salaire_annuel_max double, date_creation timestamp",
    )
    assert rows(marts.mart_offres(df), "salaire_annuel_milieu", "mois_publication") == sorted(
        [(15.0, datetime.date(2026, 3, 1)), (20.0, None), (None, None)], key=repr
    )


def test_layers(spark, tmp_path):
    sirene_schema = schemas.record(
        **dict.fromkeys(
            "siret siren denominationUsuelleEtablissement enseigne1Etablissement activitePrincipaleEtablissement "
            "trancheEffectifsEtablissement codeCommuneEtablissement codePostalEtablissement libelleCommuneEtablissement "
            "etatAdministratifEtablissement statutDiffusionEtablissement caractereEmployeurEtablissement".split(),
            schemas.STRING,
        ),
        dateCreationEtablissement=schemas.DATE,
        etablissementSiege=schemas.BOOLEAN,
    )
    raw = {name: frame(spark, schema) for name, schema in schemas.RAW_TABLES.items()}
    complete = {"date_creation": F.coalesce("date_creation", F.lit("2026-03-01").cast("timestamp")), "localisation_libelle": F.lit("Rennes")}
    raw |= {"adzuna": adzuna(spark).withColumns(complete), "france_travail": france_travail(spark)}
    shop = {"siret": "1", "siren": "2", "activitePrincipaleEtablissement": "62.01Z", "etatAdministratifEtablissement": "A"}
    shop |= {"statutDiffusionEtablissement": "O", "caractereEmployeurEtablissement": "N", "etablissementSiege": True}
    raw["sirene_etablissement"] = frame(spark, sirene_schema, shop)
    built = layers.build(spark, raw, root=str(tmp_path / "layers"))
    assert len(built) == 14
    assert spark.newSession().table("staging.stg_adzuna__offres").count() == 3
    for table in ("staging.stg_sirene__etablissements", "intermediate.int_offres_enrichies", "marts.mart_contexte_territorial"):
        assert spark.catalog.tableExists(table)
    assert spark.table("marts.mart_offres").count() == 4
    again = layers.build(spark, raw, {"stg_geo__regions": layers.VIEW}, str(tmp_path / "layers"))
    assert spark.table("staging__stg_geo__regions").count() == 0
    assert spark.table("staging.stg_adzuna__offres").count() == 3
    assert again["mart_offres"].filter(F.col("salaire_annuel_milieu").isNotNull()).count() == 3


def test_a_failed_check_stops_the_build(spark, tmp_path):
    raw = {name: frame(spark, schema) for name, schema in schemas.RAW_TABLES.items()}
    raw["adzuna"] = frame(spark, schemas.ADZUNA, {"offre_id": None, "titre": "Data Engineer", "_ingestion_date": DAY})
    with pytest.raises(CheckFailed, match="stg_adzuna__offres.offre_id not_null"):
        layers.build(spark, raw, root=str(tmp_path / "stopped"))
    assert not (tmp_path / "stopped" / "marts").exists()


def test_staged_readers_scan_what_they_select(spark, tmp_path, plan):
    path = str(tmp_path / "raw")
    adzuna(spark).withColumn("_row_hash", F.xxhash64("offre_id")).write.parquet(path)
    raw = spark.read.parquet(path)
    read = plan(offers.stg_adzuna__offres(raw).select("offre_id", "titre")).split("ReadSchema: ")[1].split("\n")[0]
    assert set(re.findall(r"(\w+):", read)) == {"offre_id", "titre", "date_creation", "_row_hash", "_ingestion_date"}
    assert "RLIKE" not in plan(offers.stg_adzuna__offres(raw).groupBy("region").count())


def test_density_has_one_row_per_commune_and_year(spark):
    data = [(c, d, "6201Z", 2023, 1, 2) for c, d in (("75101", "75"), ("75102", "92"), ("69381", "69"), ("13216", "13"), ("13055", None), ("97411", "974"))]
    df = spark.createDataFrame(data, "code_commune string, code_departement string, code_ape string, annee int, nb_etablissements int, effectifs_salaries int")
    density = intermediate.int_densite_sectorielle_commune(df)
    assert rows(density, "code_commune", "code_departement", "nb_etablissements") == [("13055", "13", 2), ("69123", "69", 1), ("75056", "75", 2), ("97411", "974", 1)]


def test_offers_without_commune_are_placed_by_departement(spark):
    _, departements, communes = geography(spark)
    raw = frame(
        spark,
        schemas.FRANCE_TRAVAIL,
        {"id": "1", "intitule": "Data Engineer", "lieuTravail": ("95 - Cergy", None, None, None, None), "_ingestion_date": DAY},
        {"id": "2", "intitule": "Data Engineer", "lieuTravail": ("Paris", None, "75011", None, None), "_ingestion_date": DAY},
        {"id": "3", "intitule": "Data Engineer", "lieuTravail": ("Paris 1er", "75101", None, None, None), "_ingestion_date": DAY},
        {"id": "4", "intitule": "Data Engineer", "_ingestion_date": DAY},
    )
    placed = intermediate.int_offres_enrichies(offers.stg_adzuna__offres(frame(spark, schemas.ADZUNA)), offers.stg_france_travail__offres(raw), communes, departements)
    assert rows(placed, "offre_id", "code_departement", "nom_commune") == [("1", "95", None), ("2", "75", None), ("3", "75", "Paris"), ("4", None, None)]
    twice = departements.union(departements.filter("code = '75'").withColumn("code", F.lit("99")))
    assert rows(intermediate.ambiguous_departements(twice), "nom_plie", "codes") == [("paris", ["75", "99"])]

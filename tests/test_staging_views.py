"""Staged models as persistent views: equal to the table form, read by name elsewhere, pruned."""

import pytest
from pyspark.sql import functions as F

from emploiscope import schemas
from emploiscope.functions import salaries, titles
from emploiscope.plans import layers, staging_views
from emploiscope.plans import staging_offers as offers
from emploiscope.plans import staging_territory as territory
from emploiscope.sources import sink
from tests.test_tables import adzuna, france_travail, frame

REGISTER = (
    "siret string, siren string, denominationUsuelleEtablissement string, enseigne1Etablissement string, "
    "activitePrincipaleEtablissement string, trancheEffectifsEtablissement string, codeCommuneEtablissement string, "
    "codePostalEtablissement string, libelleCommuneEtablissement string, dateCreationEtablissement date, etablissementSiege boolean, "
    "etatAdministratifEtablissement string, statutDiffusionEtablissement string, caractereEmployeurEtablissement string"
)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Raw tables in the catalog, offers with the hash that loads stamp."""
    root = tmp_path_factory.mktemp("views")
    tables = {name: frame(spark, schema) for name, schema in schemas.RAW_TABLES.items()}
    tables |= {"adzuna": adzuna(spark), "france_travail": france_travail(spark)}
    tables = {k: v.withColumn(sink.ROW_HASH, F.xxhash64(*v.columns)) if k in ("adzuna", "france_travail") else v for k, v in tables.items()}
    point = {"centre": {"type": "Point", "coordinates": [2.0, 48.0]}}
    tables["geo_regions"] = frame(spark, schemas.RAW_TABLES["geo_regions"], {"code": "11", "nom": "Île-de-France", "zone": "metro"})
    tables["geo_departements"] = frame(
        spark, schemas.RAW_TABLES["geo_departements"], {"code": "95", "nom": "Val-d'Oise", "codeRegion": "11"}, {"code": "99", "codeRegion": "0"}
    )
    tables["geo_communes"] = frame(
        spark, schemas.RAW_TABLES["geo_communes"], {"code": "95500", "codeDepartement": "95", "codeRegion": "11", **point}, {"code": "1"}
    )
    hiring = [{"annee": 2024, "projets_recrutement": a, "projets_difficiles": b} for a, b in ((3, 1), (0, 0), (None, 2), (8, None))]
    tables["bmo"] = frame(spark, schemas.RAW_TABLES["bmo"], *hiring)
    tables["urssaf_effectifs"] = frame(spark, schemas.RAW_TABLES["urssaf_effectifs"], {"code_commune": "1", "annee": 2023}, {"effectifs_salaries": 4})
    tables["urssaf_masse_salariale"] = frame(spark, schemas.RAW_TABLES["urssaf_masse_salariale"], {"code_na88": 62, "annee": 2020}, {"code_na88": 63})
    for name, df in tables.items():
        sink.load_table(df, f"raw_views.{name}", location=str(root / name))
    return tables


def _sorted(df):
    return sorted(map(repr, df.collect()))


def test_views_equal_the_dataframe_form(spark, raw):
    staging_views.create_views(spark, "raw_views", "staging_views")
    regions = territory.stg_geo__regions(raw["geo_regions"])
    departements = territory.stg_geo__departements(raw["geo_departements"], regions)
    expected = {
        "stg_adzuna__offres": offers.stg_adzuna__offres(raw["adzuna"]),
        "stg_france_travail__offres": offers.stg_france_travail__offres(raw["france_travail"]),
        "stg_geo__regions": regions,
        "stg_geo__departements": departements,
        "stg_geo__communes": territory.stg_geo__communes(raw["geo_communes"], departements, regions),
        "stg_bmo__projets_recrutement": territory.stg_bmo__projets_recrutement(raw["bmo"]),
        "stg_urssaf__effectifs_commune_ape": territory.stg_urssaf__effectifs_commune_ape(raw["urssaf_effectifs"]),
        "stg_urssaf__masse_salariale_na88": territory.stg_urssaf__masse_salariale_na88(raw["urssaf_masse_salariale"]),
    }
    assert expected.keys() == staging_views.VIEWS.keys()
    other = spark.newSession()
    for model, df in expected.items():
        view = other.table(f"staging_views.{model}")
        assert view.dtypes == df.dtypes, model
        assert _sorted(view) == _sorted(df), model
        assert df.count() > 0, model
    assert {t.tableType for t in spark.catalog.listTables("staging_views") if not t.isTemporary} == {"VIEW"}


def test_views_follow_their_tables(spark, raw, tmp_path):
    """A replaced raw table is seen at the next read, without making the view again."""
    for nom in ("before", "after"):
        sink.load_table(frame(spark, schemas.RAW_TABLES["geo_regions"], {"code": "1", "nom": nom}), "raw_changing.geo_regions", location=str(tmp_path / "regions"))
        if nom == "before":
            staging_views.create_functions(spark, "staging_changing")
            staging_views.create_view(spark, "stg_geo__regions", "raw_changing", "staging_changing")
        assert [r["nom"] for r in spark.newSession().table("staging_changing.stg_geo__regions").collect()] == [nom]


def test_readers_of_views_are_pruned(spark, raw, plan):
    staging_views.create_views(spark, "raw_views", "staging_views")
    view = spark.table("staging_views.stg_adzuna__offres")
    narrow = view.select("offre_id", "entreprise_nom")
    read = plan(narrow).split("ReadSchema: ")[1].split("\n")[0]
    assert "titre" not in read and "description" not in read and "entreprise_nom" in read
    assert "RLIKE" not in narrow._jdf.queryExecution().optimizedPlan().toString()
    chosen = view.filter("offre_id = '1'").select("categorie_metier")
    assert "EqualTo(offre_id,1)" in plan(chosen)
    assert chosen._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 6
    regions = spark.table("staging_views.stg_geo__communes").select("code")
    assert "centre" not in plan(regions).split("ReadSchema: ")[1].split("\n")[0]


def test_functions_equal_columns(spark):
    staging_views.create_functions(spark, "staging_views")
    said = [
        None, "", "Data Engineer (H/F)", "ingénieur  bi", "consultant power bi", "BI", "sub bi analyst", "Architecte data", "analyste de données",
        "machine learning engineer", "data scientist", "dceo engineer", "vente", "Annuel de 35000.0 Euros à 45000.0 Euros sur 13.5 mois",
        "Mensuel de 2 500 Euros", "Horaire de 12,50 Euros à 14 Euros", "Autre 12 mois", "Annuel de 35 000 à 45 000 €",
    ]
    df = spark.createDataFrame([(x,) for x in said], "x string")
    x = F.lower("x")
    columns = [titles.job_category(x), salaries.sentence_period(F.col("x")), salaries.sentence_low(F.col("x")), salaries.sentence_high(F.col("x")), salaries.sentence_months(F.col("x"))]
    names = ["job_category(lower(x))", *(f"sentence_{k}(x)" for k in ("period", "low", "high", "months"))]
    assert df.select("x", *columns).collect() == [tuple(r) for r in df.selectExpr("x", *(f"staging_views.{n}" for n in names)).collect()]


def test_layers_with_views(spark, raw, tmp_path):
    """Built over views: the register stays a table, marts equal those over staged tables."""
    complete = {"date_creation": F.coalesce("date_creation", F.lit("2026-03-01").cast("timestamp")), "localisation_libelle": F.lit("Rennes")}
    tables = {name: frame(spark, schema) for name, schema in schemas.RAW_TABLES.items()}
    tables |= {"adzuna": raw["adzuna"].withColumns(complete), "france_travail": raw["france_travail"]}
    tables["sirene_etablissement"] = spark.createDataFrame([], REGISTER)
    for name, df in tables.items():
        sink.load_table(df, f"raw_built.{name}", location=str(tmp_path / "raw" / name))
    for model in staging_views.VIEWS:
        spark.sql(f"DROP TABLE IF EXISTS staging.{model}")
    views = layers.build(spark, tables, root=str(tmp_path / "views"), raw_schema="raw_built")
    kinds = {t.name: t.tableType for t in spark.catalog.listTables("staging") if not t.isTemporary}
    assert kinds.pop("stg_sirene__etablissements") != "VIEW" and set(kinds.values()) == {"VIEW"}
    mart = _sorted(views["mart_offres"])
    with pytest.raises(ValueError, match="is a view"):
        layers.build(spark, tables, root=str(tmp_path / "tables"))
    for model in staging_views.VIEWS:
        spark.sql(f"DROP VIEW staging.{model}")
    assert mart == _sorted(layers.build(spark, tables, root=str(tmp_path / "tables"))["mart_offres"]) and len(mart) == 4
    for model in staging_views.VIEWS:
        spark.sql(f"DROP TABLE staging.{model}")

"""The staged models as persistent views over the raw tables, readable by name from any session.

A DataFrame can't become a view that other sessions read, so the views are SQL text. The rules that
are more than a cast, such as the title classifier, are permanent SQL functions made from the same
fixed values as the DataFrame form. Spark puts a function's expression into the reader's plan, so a
reader that selects no category evaluates no pattern and scans no title.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emploiscope.functions import salaries as pay
from emploiscope.functions import titles
from emploiscope.plans.staging_offers import ADZUNA_COLUMNS
from emploiscope.sources.sink import ROW_HASH


def _text(value: str) -> str:
    """A raw SQL string literal; none of the fixed values holds a quote."""
    return f"r'{value}'"


def _category_rule() -> str:
    branches = []
    for category, pattern in titles.CATEGORY_PATTERNS.items():
        groups = titles.REQUIRED_WORDS[category]
        quick = " AND ".join("(" + " OR ".join(f"contains(title, {_text(w)})" for w in words) + ")" for words in groups)
        full = f"(?=[{titles.FIRST_LETTERS[category]}])(?:{titles.re2_pattern(pattern)})"
        branches.append(f"WHEN {quick} AND title RLIKE {_text(full)} THEN {_text(category)}")
    return f"CASE {' '.join(branches)} ELSE {_text(titles.OTHER_CATEGORY)} END"


def _number(text: str) -> str:
    return f"CAST(nullif(regexp_replace(regexp_replace({text}, {_text(pay.GAP)}, ''), ',', '.'), '') AS DOUBLE)"


def _found(pattern: str, group: int) -> str:
    return _number(f"regexp_extract(sentence, {_text(pattern)}, {group})")


def functions() -> dict[str, tuple[str, str, str]]:
    """Name to parameters, type and expression of the permanent functions."""
    year, month = pay.ANNUAL_RANGE, pay.MONTHLY_RANGE
    word = f"lower(regexp_extract(sentence, {_text('^ *([A-Za-z]+)')}, 1))"
    return {
        "job_category": ("title STRING", "STRING", _category_rule()),
        "salary_source": ("low DOUBLE, high DOUBLE", "STRING", "CASE WHEN low IS NOT NULL OR high IS NOT NULL THEN 'declare' END"),
        "salary_period": (
            "low DOUBLE, high DOUBLE",
            "STRING",
            f"CASE WHEN coalesce(low, high) BETWEEN {year[0]} AND {year[1]} THEN 'annuel'"
            f" WHEN coalesce(low, high) BETWEEN {month[0]} AND {month[1]} THEN 'mensuel' END",
        ),
        "annual_salary": (
            "period STRING, amount DOUBLE, months DOUBLE",
            "DOUBLE",
            f"CASE period WHEN 'annuel' THEN amount WHEN 'mensuel' THEN amount * months WHEN 'horaire' THEN amount * {pay.HOURS_PER_YEAR}D END",
        ),
        "sentence_period": ("sentence STRING", "STRING", f"CASE WHEN {word} IN ('annuel', 'mensuel', 'horaire') THEN {word} END"),
        "sentence_low": ("sentence STRING", "DOUBLE", f"coalesce({_found(pay.RANGE, 1)}, {_found(pay.SINGLE, 1)})"),
        "sentence_high": ("sentence STRING", "DOUBLE", _found(pay.RANGE, 2)),
        "sentence_months": (
            "sentence STRING",
            "DOUBLE",
            f"coalesce({_found('sur ' + pay.AMOUNT + ' *mois', 1)}, {float(pay.MONTHS_PER_YEAR)}D)",
        ),
    }


def create_functions(spark: SparkSession, schema: str) -> None:
    """Create or replace the functions; views made before follow the new rules."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    for name, (parameters, kind, body) in functions().items():
        spark.sql(f"CREATE OR REPLACE FUNCTION `{schema}`.{name}({parameters}) RETURNS {kind} RETURN {body}")


def _latest(table: str, key: str, has_hash: bool, created: str) -> str:
    order = ["_ingestion_date DESC", f"{created} DESC", *([f"{ROW_HASH} DESC"] if has_hash else [])]
    ranked = f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {', '.join(order)}) AS _rank FROM {table}"
    return f"(SELECT * FROM ({ranked}) WHERE _rank = 1)"


_FLAGS = f"""if(categorie_metier <> '{titles.OTHER_CATEGORY}', true, false) AS is_metier_data,
       if(categorie_metier = 'data_engineer', true, false) AS is_data_engineer"""


def _adzuna(raw: str, schema: str, has_hash: bool) -> str:
    return f"""
SELECT {", ".join(ADZUNA_COLUMNS)} FROM (
SELECT *, {_FLAGS} FROM (
SELECT *, {schema}.job_category(lower(titre)) AS categorie_metier,
       salaire_periodicite_inferree IS NOT NULL AS is_salaire_periodicite_inferree,
       {schema}.annual_salary(salaire_periodicite_inferree, salaire_min, {pay.MONTHS_PER_YEAR}.0D) AS salaire_annuel_min,
       {schema}.annual_salary(salaire_periodicite_inferree, coalesce(salaire_max, salaire_min), {pay.MONTHS_PER_YEAR}.0D) AS salaire_annuel_max
FROM (
SELECT CAST(offre_id AS STRING) AS offre_id, titre, description, date_creation, 'adzuna' AS source, entreprise_nom, localisation_libelle,
       get(localisation_area, 1) AS region, get(localisation_area, 2) AS departement_nom,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       CAST(salaire_min AS DOUBLE) AS salaire_min, CAST(salaire_max AS DOUBLE) AS salaire_max,
       {schema}.salary_source(salaire_min, salaire_max) AS source_salaire,
       {schema}.salary_period(salaire_min, salaire_max) AS salaire_periodicite_inferree,
       CAST(salaire_est_estime AS BIGINT) AS salaire_est_estime,
       type_contrat, temps_travail, categorie_tag, categorie_libelle, redirect_url
FROM {_latest(f"{raw}.adzuna", "offre_id", has_hash, "date_creation")})))"""


def _france_travail(raw: str, schema: str, has_hash: bool) -> str:
    return f"""
SELECT offre_id, titre, description, date_creation, code_rome, entreprise_nom, localisation_libelle, code_commune, code_postal,
       latitude, longitude, salaire_libelle, type_contrat, temps_travail, source, salaire_periodicite, salaire_min, salaire_max,
       {schema}.salary_source(salaire_min, salaire_max) AS source_salaire,
       {schema}.annual_salary(salaire_periodicite, salaire_min, salaire_mois) AS salaire_annuel_min,
       {schema}.annual_salary(salaire_periodicite, coalesce(salaire_max, salaire_min), salaire_mois) AS salaire_annuel_max,
       categorie_metier, {_FLAGS}
FROM (
SELECT id AS offre_id, intitule AS titre, description, dateCreation AS date_creation, romeCode AS code_rome,
       entreprise.nom AS entreprise_nom, lieuTravail.libelle AS localisation_libelle, lieuTravail.commune AS code_commune,
       lieuTravail.codePostal AS code_postal, lieuTravail.latitude AS latitude, lieuTravail.longitude AS longitude,
       salaire.libelle AS salaire_libelle, typeContrat AS type_contrat, dureeTravailLibelleConverti AS temps_travail,
       'france_travail' AS source,
       {schema}.sentence_period(salaire.libelle) AS salaire_periodicite,
       {schema}.sentence_low(salaire.libelle) AS salaire_min,
       {schema}.sentence_high(salaire.libelle) AS salaire_max,
       {schema}.sentence_months(salaire.libelle) AS salaire_mois,
       {schema}.job_category(lower(intitule)) AS categorie_metier
FROM {_latest(f"{raw}.france_travail", "id", has_hash, "dateCreation")})"""


def _regions(raw: str, schema: str, has_hash: bool) -> str:
    return f"SELECT code, nom, zone AS zone_geo FROM {raw}.geo_regions"


def _departements(raw: str, schema: str, has_hash: bool) -> str:
    return f"""
SELECT d.code, d.nom, d.codeRegion AS code_region, r.nom AS nom_region, d.zone AS zone_geo
FROM {raw}.geo_departements d LEFT JOIN {schema}.stg_geo__regions r ON d.codeRegion = r.code"""


def _communes(raw: str, schema: str, has_hash: bool) -> str:
    return f"""
SELECT c.code, c.nom, c.codeDepartement AS code_departement, d.nom AS nom_departement, c.codeRegion AS code_region, r.nom AS nom_region,
       c.population, c.centre.coordinates[1] AS centre_lat, c.centre.coordinates[0] AS centre_lon
FROM {raw}.geo_communes c
LEFT JOIN {schema}.stg_geo__departements d ON c.codeDepartement = d.code
LEFT JOIN {schema}.stg_geo__regions r ON c.codeRegion = r.code"""


def _bmo(raw: str, schema: str, has_hash: bool) -> str:
    return f"""
SELECT annee, code_metier_bmo, libelle_metier_bmo, code_famille_metier, libelle_famille_metier, code_region, nom_region,
       code_departement, nom_departement, code_bassin_emploi, libelle_bassin_emploi,
       projets_recrutement, projets_difficiles, projets_saisonniers,
       if(projets_recrutement > 0, round(projets_difficiles * 100.0D / projets_recrutement, 1), NULL) AS part_difficile_pct
FROM {raw}.bmo"""


def _headcounts(raw: str, schema: str, has_hash: bool) -> str:
    return f"""
SELECT code_commune, intitule_commune, code_departement, code_ape, annee,
       coalesce(nb_etablissements, 0L) AS nb_etablissements, coalesce(effectifs_salaries, 0L) AS effectifs_salaries
FROM {raw}.urssaf_effectifs"""


def _payroll(raw: str, schema: str, has_hash: bool) -> str:
    columns = ["annee", "nb_etablissements", "effectifs_salaries_moyens", "masse_salariale_brute"]
    return f"""
SELECT CAST(code_na88 AS BIGINT) AS code_na88, libelle_na88, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)}
FROM {raw}.urssaf_masse_salariale WHERE code_na88 = 62"""


# Each view and its raw table, in an order in which every view finds those it reads. The register
# (``stg_sirene__etablissements``) is declared a table and isn't among them.
VIEWS: dict[str, tuple[str, Callable[[str, str, bool], str]]] = {
    "stg_adzuna__offres": ("adzuna", _adzuna),
    "stg_france_travail__offres": ("france_travail", _france_travail),
    "stg_geo__regions": ("geo_regions", _regions),
    "stg_geo__departements": ("geo_departements", _departements),
    "stg_geo__communes": ("geo_communes", _communes),
    "stg_bmo__projets_recrutement": ("bmo", _bmo),
    "stg_urssaf__effectifs_commune_ape": ("urssaf_effectifs", _headcounts),
    "stg_urssaf__masse_salariale_na88": ("urssaf_masse_salariale", _payroll),
}


def create_view(spark: SparkSession, model: str, raw: str = "raw", schema: str = "staging") -> DataFrame:
    """Create or replace the view ``schema.model`` over the tables of ``raw`` and return it.

    The functions must exist. A table of the same name is an error, not replaced: Spark says which.
    """
    table, text = VIEWS[model]
    has_hash = ROW_HASH in spark.table(f"`{raw}`.{table}").columns
    spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.{model} AS {text(f'`{raw}`', f'`{schema}`', has_hash)}")
    return spark.table(f"`{schema}`.{model}")


def create_views(spark: SparkSession, raw: str = "raw", schema: str = "staging") -> dict[str, DataFrame]:
    """All functions and views of the staging layer, by model name."""
    create_functions(spark, schema)
    return {model: create_view(spark, model, raw, schema) for model in VIEWS}

"""Staged reference and territorial tables: geography, hiring survey, headcounts, payroll, register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.functions.codes import rounded_percentage
from emploiscope.operators.lookup import add_names


def stg_geo__regions(raw: DataFrame) -> DataFrame:
    return raw.select("code", "nom", F.col("zone").alias("zone_geo"))


def stg_geo__departements(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """Départements with the name of their region, NULL where the region is unknown."""
    named = add_names(raw, regions, F.col("codeRegion"), "code", {"nom_region": "nom"})
    return named.select("code", "nom", F.col("codeRegion").alias("code_region"), "nom_region", F.col("zone").alias("zone_geo"))


def stg_geo__communes(raw: DataFrame, departements: DataFrame, regions: DataFrame) -> DataFrame:
    """Communes with parent names and the centre's coordinates.

    GeoJSON points are (longitude, latitude). A point with fewer than two numbers is an
    error under ANSI mode; no point gives NULLs.
    """
    located = add_names(raw, departements, F.col("codeDepartement"), "code", {"nom_departement": "nom"})
    located = add_names(located, regions, F.col("codeRegion"), "code", {"nom_region": "nom"})
    point = F.col("centre.coordinates")
    return located.select(
        "code",
        "nom",
        F.col("codeDepartement").alias("code_departement"),
        "nom_departement",
        F.col("codeRegion").alias("code_region"),
        "nom_region",
        "population",
        point[1].alias("centre_lat"),
        point[0].alias("centre_lon"),
    )


def stg_bmo__projets_recrutement(raw: DataFrame) -> DataFrame:
    """Hiring projects by labour-market area and job, with the share judged difficult."""
    return raw.select(
        "annee",
        "code_metier_bmo",
        "libelle_metier_bmo",
        "code_famille_metier",
        "libelle_famille_metier",
        "code_region",
        "nom_region",
        "code_departement",
        "nom_departement",
        "code_bassin_emploi",
        "libelle_bassin_emploi",
        "projets_recrutement",
        "projets_difficiles",
        "projets_saisonniers",
        rounded_percentage(F.col("projets_difficiles"), F.col("projets_recrutement")).alias("part_difficile_pct"),
    )


def stg_urssaf__effectifs_commune_ape(raw: DataFrame) -> DataFrame:
    """Headcount and establishments by commune, activity and year; missing measures are 0."""
    zero = F.lit(0).cast("bigint")
    return raw.select(
        "code_commune",
        "intitule_commune",
        "code_departement",
        "code_ape",
        "annee",
        F.coalesce("nb_etablissements", zero).alias("nb_etablissements"),
        F.coalesce("effectifs_salaries", zero).alias("effectifs_salaries"),
    )


def stg_urssaf__masse_salariale_na88(raw: DataFrame) -> DataFrame:
    """[declared] Gross payroll of sector 62 by year; the columns are our decision."""
    return raw.filter(F.col("code_na88") == 62).select(
        F.col("code_na88").cast("bigint").alias("code_na88"),
        "libelle_na88",
        F.col("annee").cast("bigint").alias("annee"),
        F.col("nb_etablissements").cast("bigint").alias("nb_etablissements"),
        F.col("effectifs_salaries_moyens").cast("bigint").alias("effectifs_salaries_moyens"),
        F.col("masse_salariale_brute").cast("bigint").alias("masse_salariale_brute"),
    )


def active_establishments(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("etatAdministratifEtablissement") == "A")


def stg_sirene__etablissements(raw: DataFrame) -> DataFrame:
    """Active establishments; a NULL status gives a NULL flag, not FALSE."""
    return active_establishments(raw).select(
        "siret",
        "siren",
        F.col("denominationUsuelleEtablissement").alias("denomination_usuelle"),
        F.col("enseigne1Etablissement").alias("enseigne"),
        F.col("activitePrincipaleEtablissement").alias("code_naf"),
        F.col("trancheEffectifsEtablissement").alias("tranche_effectifs"),
        F.col("codeCommuneEtablissement").alias("code_commune"),
        F.col("codePostalEtablissement").alias("code_postal"),
        F.col("libelleCommuneEtablissement").alias("libelle_commune"),
        F.col("dateCreationEtablissement").alias("date_creation"),
        F.col("etablissementSiege").alias("is_siege"),
        (F.col("statutDiffusionEtablissement") == "P").alias("is_diffusion_partielle"),
        (F.col("caractereEmployeurEtablissement") == "O").alias("is_employeur"),
    )

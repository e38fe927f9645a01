"""Intermediate tables. All are [declared]: only their purpose is specified, columns are ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emploiscope.functions.codes import city_commune, departement_of_commune, name_key
from emploiscope.operators.lookup import add_names, unique_lookup
from emploiscope.operators.nearest import nearest_places

_SHARED = [
    "offre_id",
    "source",
    "titre",
    "description",
    "date_creation",
    "categorie_metier",
    "is_data_engineer",
    "entreprise_nom",
    "localisation_libelle",
    "latitude",
    "longitude",
    "source_salaire",
    "salaire_annuel_min",
    "salaire_annuel_max",
    "type_contrat",
    "temps_travail",
]


def int_offres_enrichies(adzuna: DataFrame, france_travail: DataFrame, communes: DataFrame, departements: DataFrame) -> DataFrame:
    """[declared] Data offers of both sources in one table, with geographic names.

    France Travail offers are placed by commune code, arrondissements as their city; one
    without a commune is placed by the département of its place name ("69 - Lyon") or else of its
    postal code. Adzuna offers carry no code and are placed by folded département name; those that
    ``with_nearest_commune`` has given a commune get its name too. An offer that cannot be placed is
    kept with NULL names.
    """
    # One pass over the offers: a row has a commune or a département to look up, never both.
    coded = france_travail.filter("is_metier_data").select(
        *_SHARED,
        city_commune(F.col("code_commune")).alias("code_commune"),
        F.when(F.col("code_commune").isNull(), _departement_code()).alias("_departement"),
    )
    placed = ["code_departement", "nom_departement", "code_region", "nom_region"]
    named = add_names(coded, communes, F.col("code_commune"), "code", {"nom_commune": "nom", **{name: name for name in placed}})
    fallback = {f"_{name}": source for name, source in zip(placed, ["code", "nom", "code_region", "nom_region"], strict=True)}
    named = add_names(named, departements, F.col("_departement"), "code", fallback)
    by_code = named.select(
        *_SHARED, "code_commune", "nom_commune", *(F.when(F.col("code_commune").isNull(), F.col(f"_{name}")).otherwise(F.col(name)).alias(name) for name in placed)
    )
    names = unique_lookup(departements, name_key(F.col("nom")), ["code", "nom", "code_region", "nom_region"])
    commune = ["code_commune"] if "code_commune" in adzuna.columns else []
    by_name = add_names(
        adzuna.filter("is_metier_data").select(*_SHARED, *commune, name_key(F.col("departement_nom")).alias("_place")),
        names,
        F.col("_place"),
        "_key",
        {"code_departement": "code", "nom_departement": "nom", "code_region": "code_region", "nom_region": "nom_region"},
    ).drop("_place")
    if commune:
        by_name = add_names(by_name, communes, F.col("code_commune"), "code", {"nom_commune": "nom"})
    return by_code.unionByName(by_name, allowMissingColumns=True)


def with_nearest_commune(offers: DataFrame, communes: DataFrame) -> DataFrame:
    """[declared] ``offers`` with the ``code_commune`` whose centre is nearest to their coordinates, NULL without any."""
    centres = communes.select("code", F.col("centre_lat").alias("latitude"), F.col("centre_lon").alias("longitude"))
    nearest = nearest_places(offers, centres, "code").select(F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), F.col("code").alias("code_commune"))
    same = (F.col("latitude") == F.col("_lat")) & (F.col("longitude") == F.col("_lon"))
    return offers.join(nearest, same, "left").drop("_lat", "_lon")


def _departement_code() -> Column:
    """From a place name that begins with the code, or from the postal code."""
    named = F.regexp_extract("localisation_libelle", "^(2[AB]|9[78][0-9]|[0-9]{2}) *-", 1)
    return F.coalesce(F.nullif(named, F.lit("")), departement_of_commune(F.col("code_postal")))


def ambiguous_departements(departements: DataFrame) -> DataFrame:
    """Folded names that several départements share, with their codes: offers go to the smallest code."""
    names = departements.groupBy(name_key(F.col("nom")).alias("nom_plie"))
    return names.agg(F.sort_array(F.collect_set("code")).alias("codes")).filter(F.size("codes") > 1)


def unplaced_offers(offers: DataFrame) -> DataFrame:
    """Per source, the number of offers and of those without a département."""
    return offers.groupBy("source").agg(
        F.count("*").alias("n_offres"),
        F.count_if(F.col("code_departement").isNull()).alias("n_sans_departement"),
    )


def int_densite_sectorielle_commune(effectifs: DataFrame) -> DataFrame:
    """[declared] Headcount and establishments of the sector by commune and year.

    Arrondissements of Paris, Lyon and Marseille are added up as their commune. The département
    is that of the commune, so there is one row per commune and year.
    """
    commune = city_commune(F.col("code_commune"))
    return (
        effectifs.withColumn("code_commune", commune)
        .groupBy("code_commune", departement_of_commune(F.col("code_commune")).alias("code_departement"), "annee")
        .agg(
            F.sum("nb_etablissements").alias("nb_etablissements"),
            F.sum("effectifs_salaries").alias("effectifs_salaries"),
        )
    )


def int_tensions_bassin_emploi(bmo: DataFrame) -> DataFrame:
    """[declared] Hiring projects and difficulty rate by département and year.

    The rate uses only rows where both numbers are published: masked numbers would
    otherwise count in one term and not in the other.
    """
    total, hard = F.col("projets_recrutement"), F.col("projets_difficiles")
    both = total.isNotNull() & hard.isNotNull()
    sums = bmo.groupBy("code_departement", "annee").agg(
        F.sum(total).alias("projets_recrutement"),
        F.sum(hard).alias("projets_difficiles"),
        F.sum(F.when(both, total)).alias("_total"),
        F.sum(F.when(both, hard)).alias("_hard"),
    )
    rate = F.when(F.col("_total") > 0, F.round(F.col("_hard") * F.lit(100.0) / F.col("_total"), 1))
    return sums.select(
        "code_departement", "annee", "projets_recrutement", "projets_difficiles", rate.alias("taux_difficulte_pct")
    )

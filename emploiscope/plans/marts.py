"""Marts. All are [declared]: only their purpose is specified, columns are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.functions.salaries import midpoint
from emploiscope.operators.latest import first_per_key
from emploiscope.operators.quantile import median_profile


def mart_offres(offers: DataFrame) -> DataFrame:
    """[declared] Enriched offers with the middle of the annual salary and the month of publication."""
    return offers.withColumn(
        "salaire_annuel_milieu", midpoint(F.col("salaire_annuel_min"), F.col("salaire_annuel_max"))
    ).withColumn("mois_publication", F.date_trunc("month", "date_creation").cast("date"))


def mart_contexte_territorial(density: DataFrame, tension: DataFrame, payroll: DataFrame) -> DataFrame:
    """[declared] By département and year: sector density, hiring tension, national pay per head.

    Both inputs are summed to one row per département and year before they meet.
    """
    keys = ["code_departement", "annee"]
    sector = density.groupBy(*keys).agg(
        F.count("*").alias("nb_communes"),
        F.sum("nb_etablissements").alias("nb_etablissements"),
        F.sum("effectifs_salaries").alias("effectifs_salaries"),
    )
    per_year = payroll.groupBy("annee").agg(
        F.sum("masse_salariale_brute").alias("_pay"), F.sum("effectifs_salaries_moyens").alias("_heads")
    )
    pay = per_year.select("annee", F.round(F.col("_pay") / F.nullif(F.col("_heads"), F.lit(0)), 2).alias("salaire_moyen_national"))
    return sector.join(tension, keys, "full_outer").join(pay, "annee", "left")


def category_salaries(offers: DataFrame, category: str = "categorie_metier") -> DataFrame:
    """Offers and exact median annual salary per job category, in one pass over ``offers``."""
    priced = offers.select(category, midpoint(F.col("salaire_annuel_min"), F.col("salaire_annuel_max")).alias("_pay"))
    return median_profile(priced, [category], "_pay", "n_offres", "n_avec_salaire", "salaire_annuel_median")


def region_summary(offers: DataFrame) -> DataFrame:
    """[declared] Where, which companies, what pay: offers, companies and median salary by region.

    Offers are counted per region, company and salary first; that one table, read once from
    the offers, gives the companies and the medians. Offers without a region form the NULL row.
    """
    facts = offers.groupBy("nom_region", "entreprise_nom", "salaire_annuel_milieu").agg(F.count("*").alias("_offers"))
    per_company = facts.groupBy(F.col("nom_region").alias("_region"), "entreprise_nom").agg(F.sum("_offers").alias("_n"))
    companies = per_company.groupBy("_region").agg(
        F.sum("_n").alias("n_offres"), F.count("entreprise_nom").alias("n_entreprises")
    )
    pay = median_profile(
        facts, ["nom_region"], "salaire_annuel_milieu", median="salaire_annuel_median", weight="_offers"
    )
    joined = pay.join(companies, F.col("nom_region").eqNullSafe(F.col("_region")))
    return joined.select("nom_region", "n_offres", "n_entreprises", "salaire_annuel_median")


def top_companies(offers: DataFrame, k: int = 10) -> DataFrame:
    """[declared] The ``k`` companies with most offers in each region; equal counts go by name."""
    named = offers.filter(F.col("entreprise_nom").isNotNull())
    counts = named.groupBy("nom_region", "entreprise_nom").agg(F.count("*").alias("n_offres"))
    return first_per_key(counts, ["nom_region"], [F.col("n_offres").desc(), F.col("entreprise_nom")], k)

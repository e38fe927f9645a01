"""Building the staging, intermediate and mart layers from raw tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from emploiscope.operators.quality import enforce
from emploiscope.plans import intermediate, marts, staging_views
from emploiscope.plans import staging_offers as offers
from emploiscope.plans import staging_territory as territory
from emploiscope.plans.declared_checks import CHECKS, check_model
from emploiscope.sources.sink import load_table

log = logging.getLogger(__name__)

VIEW, TABLE = "view", "table"

# How each layer is materialised from DataFrames. Staged models are tables unless ``build`` is given
# the schema of the raw tables: a DataFrame can't become a view that other sessions read, and
# several models and all checks read each of them.
LAYER_KIND = {"staging": TABLE, "intermediate": TABLE, "marts": TABLE}
MODEL_KIND: dict[str, str] = {}


def materialise(
    df: DataFrame, layer: str, model: str, kinds: Mapping[str, str] = MODEL_KIND, location: str | None = None
) -> DataFrame:
    """Make ``model`` readable by name and return it as the next model should read it.

    Tables are ``layer.model``, the layer name used as it is, readable from any session of the
    catalog. ``kinds`` may make single models session views called ``layer__model`` instead.
    """
    if kinds.get(model, LAYER_KIND[layer]) == VIEW:
        df.createOrReplaceTempView(f"{layer}__{model}")
        return df.sparkSession.table(f"{layer}__{model}")
    load_table(df, f"{layer}.{model}", location=location)
    return df.sparkSession.table(f"{layer}.{model}")


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    kinds: Mapping[str, str] = MODEL_KIND,
    root: str | None = None,
    raw_schema: str | None = None,
) -> dict[str, DataFrame]:
    """All layers from the raw tables, keyed by model name; tables go under ``root`` if given.

    With ``raw_schema``, the catalog schema that holds the raw tables, staged models are persistent
    views over them and only the register stays a table. Every reader then runs the view's plan, so
    tables are the cheaper form where the classified offers are read often.

    The declared checks of a staged model run as soon as it is built. One of severity error
    that fails raises ``CheckFailed``, and nothing after it is built; those of severity warn are
    logged.
    """
    built: dict[str, DataFrame] = {}
    if raw_schema:
        staging_views.create_functions(spark, "staging")

    def add(layer: str, model: str, df: DataFrame) -> DataFrame:
        location = f"{root.rstrip('/')}/{layer}/{model}" if root else None
        if raw_schema and model in staging_views.VIEWS:
            built[model] = staging_views.create_view(spark, model, raw_schema, layer)
        else:
            built[model] = materialise(df, layer, model, kinds, location)
        if model in CHECKS:
            report = check_model(built[model], model, built).collect()  # one row per declared check
            for row in report:
                if row["failures"]:
                    log.warning("%s.%s %s: %s failures (%s)", row["model"], row["column"], row["test"], row["failures"], row["severity"])
            enforce(report)
        return built[model]

    adzuna = add("staging", "stg_adzuna__offres", offers.stg_adzuna__offres(raw["adzuna"]))
    france_travail = add(
        "staging", "stg_france_travail__offres", offers.stg_france_travail__offres(raw["france_travail"])
    )
    regions = add("staging", "stg_geo__regions", territory.stg_geo__regions(raw["geo_regions"]))
    departements = add(
        "staging", "stg_geo__departements", territory.stg_geo__departements(raw["geo_departements"], regions)
    )
    communes = add(
        "staging", "stg_geo__communes", territory.stg_geo__communes(raw["geo_communes"], departements, regions)
    )
    bmo = add("staging", "stg_bmo__projets_recrutement", territory.stg_bmo__projets_recrutement(raw["bmo"]))
    effectifs = add(
        "staging",
        "stg_urssaf__effectifs_commune_ape",
        territory.stg_urssaf__effectifs_commune_ape(raw["urssaf_effectifs"]),
    )
    payroll = add(
        "staging",
        "stg_urssaf__masse_salariale_na88",
        territory.stg_urssaf__masse_salariale_na88(raw["urssaf_masse_salariale"]),
    )
    add(
        "staging",
        "stg_sirene__etablissements",
        territory.stg_sirene__etablissements(raw["sirene_etablissement"]),
    )

    enriched = add(
        "intermediate",
        "int_offres_enrichies",
        intermediate.int_offres_enrichies(adzuna, france_travail, communes, departements),
    )
    density = add(
        "intermediate", "int_densite_sectorielle_commune", intermediate.int_densite_sectorielle_commune(effectifs)
    )
    tension = add("intermediate", "int_tensions_bassin_emploi", intermediate.int_tensions_bassin_emploi(bmo))

    add("marts", "mart_offres", marts.mart_offres(enriched))
    add("marts", "mart_contexte_territorial", marts.mart_contexte_territorial(density, tension, payroll))
    return built

"""The checks declared on each staged table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from emploiscope.functions.codes import ORPHAN_TERRITORIES
from emploiscope.functions.titles import CATEGORIES
from emploiscope.operators.quality import (
    WARN,
    Check,
    accepted_values,
    not_null,
    relationships,
    run_checks,
    unique,
    unique_combination,
)

# Accepted codes and the restriction of the commune checks.
ZONES = ["metro", "drom", "com"]
BMO_CODES = ["M1X80", "M1X81", "M2X90", "M2X91", "M2X92", "M2X93"]
BMO_FAMILIES = ["A", "C"]
APE_CODES = ["6201Z", "6202A", "6203Z", "6209Z"]
_LISTED = "(" + ", ".join(f"'{code}'" for code in ORPHAN_TERRITORIES) + ")"

CHECKS: dict[str, list[Check]] = {
    "stg_adzuna__offres": [
        unique("offre_id"),
        not_null("offre_id"),
        not_null("titre"),
        not_null("date_creation"),
        not_null("source"),
        accepted_values("source", ["adzuna"]),
        not_null("categorie_metier"),
        accepted_values("categorie_metier", CATEGORIES),
        not_null("is_metier_data"),
        not_null("is_data_engineer"),
        not_null("localisation_libelle"),
        accepted_values("source_salaire", ["declare"], where="source_salaire IS NOT NULL"),
    ],
    "stg_geo__regions": [
        unique("code"),
        not_null("code"),
        not_null("nom"),
        not_null("zone_geo"),
        accepted_values("zone_geo", ZONES),
    ],
    "stg_geo__departements": [
        unique("code"),
        not_null("code"),
        not_null("nom"),
        not_null("code_region"),
        relationships("code_region", "stg_geo__regions", "code"),
        not_null("nom_region"),
        not_null("zone_geo"),
        accepted_values("zone_geo", ZONES),
    ],
    # A NULL code makes NOT IN unknown, which leaves the row out: these not_null checks on
    # the restricting column itself cannot fail. Kept as declared.
    "stg_geo__communes": [
        unique("code"),
        not_null("code"),
        not_null("nom"),
        not_null("code_departement", where=f"code_departement NOT IN {_LISTED}"),
        relationships("code_departement", "stg_geo__departements", "code", where=f"code_departement NOT IN {_LISTED}"),
        not_null("nom_departement", where=f"code_departement NOT IN {_LISTED}"),
        not_null("code_region", where=f"code_region NOT IN {_LISTED}"),
        relationships("code_region", "stg_geo__regions", "code", where=f"code_region NOT IN {_LISTED}"),
        not_null("nom_region", where=f"code_region NOT IN {_LISTED}"),
    ],
    "stg_bmo__projets_recrutement": [
        unique_combination("annee", "code_bassin_emploi", "code_departement", "code_metier_bmo"),
        not_null("annee"),
        not_null("code_metier_bmo"),
        accepted_values("code_metier_bmo", BMO_CODES),
        accepted_values("code_famille_metier", BMO_FAMILIES),
        not_null("code_departement"),
        not_null("code_bassin_emploi"),
    ],
    "stg_urssaf__effectifs_commune_ape": [
        unique_combination("code_commune", "code_ape", "annee"),
        not_null("code_commune"),
        not_null("code_departement"),
        not_null("code_ape"),
        accepted_values("code_ape", APE_CODES),
        not_null("annee"),
        not_null("nb_etablissements"),
        not_null("effectifs_salaries"),
    ],
    "stg_sirene__etablissements": [
        unique("siret"),
        not_null("siret"),
        not_null("siren"),
        not_null("code_naf"),
        not_null("code_commune", severity=WARN),
        not_null("is_siege"),
        accepted_values("is_siege", [True, False]),
        not_null("is_diffusion_partielle"),
        accepted_values("is_diffusion_partielle", [True, False]),
        not_null("is_employeur", severity=WARN),
        accepted_values("is_employeur", [True, False]),
    ],
}


def check_model(df: DataFrame, model: str, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The report of the checks declared on ``model``."""
    return run_checks(df, model, CHECKS[model], parents)

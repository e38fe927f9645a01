"""The tables written as SQL, for comparison with the DataFrame versions."""

from __future__ import annotations

from crosscheck.inputs import SQL as INPUTS
from emploiscope.functions.titles import CATEGORY_PATTERNS
from emploiscope.plans.declared_checks import APE_CODES, BMO_CODES
from crosscheck.inputs import YEARS


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def category_case(title: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({title}, '{p}') THEN '{c}'" for c, p in CATEGORY_PATTERNS.items())
    return f"CASE {arms} ELSE 'autre_it' END"


def enriched_adzuna(source: str) -> str:
    """Typed, priced and classified offers of ``source``, every intermediate column kept."""
    return f"""
SELECT *, categorie_metier <> 'autre_it' AS is_metier_data, categorie_metier = 'data_engineer' AS is_data_engineer,
       CASE salaire_periodicite_inferree WHEN 'annuel' THEN salaire_min WHEN 'mensuel' THEN salaire_min * 12
            END AS salaire_annuel_min,
       CASE salaire_periodicite_inferree WHEN 'annuel' THEN coalesce(salaire_max, salaire_min)
            WHEN 'mensuel' THEN coalesce(salaire_max, salaire_min) * 12 END AS salaire_annuel_max
FROM (SELECT *, salaire_periodicite_inferree IS NOT NULL AS is_salaire_periodicite_inferree,
             {category_case("titre_normalise")} AS categorie_metier
      FROM (SELECT *, 'adzuna' AS source, localisation_area[2] AS region, localisation_area[3] AS departement_nom,
                   lower(titre) AS titre_normalise,
                   CASE WHEN salaire_min IS NOT NULL OR salaire_max IS NOT NULL THEN 'declare' END AS source_salaire,
                   CASE WHEN coalesce(salaire_min, salaire_max) BETWEEN 15000 AND 250000 THEN 'annuel'
                        WHEN coalesce(salaire_min, salaire_max) BETWEEN 1000 AND 14999 THEN 'mensuel'
                        END AS salaire_periodicite_inferree
            FROM {source}))"""


_NAME = "trim(regexp_replace(translate(lower({0}), 'àâäçéèêëîïôöùûüÿ', 'aaaceeeeiioouuuy'), '[-''’ ]+', ' ', 'g'))"

_CITY = """(CASE WHEN code_commune BETWEEN '75101' AND '75120' THEN '75056' WHEN code_commune BETWEEN '69381' AND '69389' THEN '69123'
      WHEN code_commune BETWEEN '13201' AND '13216' THEN '13055' ELSE code_commune END)"""

MODELS: dict[str, str] = {
    "latest_adzuna": """
SELECT * FROM adzuna
QUALIFY row_number() OVER (PARTITION BY offre_id ORDER BY _ingestion_date DESC, date_creation DESC) = 1""",
    "raw_adzuna_enriched": enriched_adzuna("adzuna"),
    "stg_adzuna": enriched_adzuna("latest_adzuna"),
    "stg_france_travail": f"""
SELECT *, categorie_metier <> 'autre_it' AS is_metier_data, categorie_metier = 'data_engineer' AS is_data_engineer,
       CASE salaire_periodicite WHEN 'annuel' THEN salaire_min WHEN 'mensuel' THEN salaire_min * mois
            WHEN 'horaire' THEN salaire_min * 1820 END AS salaire_annuel_min,
       CASE salaire_periodicite WHEN 'annuel' THEN coalesce(salaire_max, salaire_min)
            WHEN 'mensuel' THEN coalesce(salaire_max, salaire_min) * mois
            WHEN 'horaire' THEN coalesce(salaire_max, salaire_min) * 1820 END AS salaire_annuel_max,
       CASE WHEN salaire_min IS NOT NULL OR salaire_max IS NOT NULL THEN 'declare' END AS source_salaire
FROM (SELECT id AS offre_id, intitule AS titre, description, dateCreation AS date_creation, 'france_travail' AS source,
             romeCode AS code_rome, entreprise_nom, lieu AS localisation_libelle, commune AS code_commune, code_postal,
             latitude, longitude, salaire_libelle, typeContrat AS type_contrat, dureeTravailLibelleConverti AS temps_travail,
             CASE WHEN lower(split_part(salaire_libelle, ' ', 1)) IN ('annuel', 'mensuel', 'horaire')
                  THEN lower(split_part(salaire_libelle, ' ', 1)) END AS salaire_periodicite,
             TRY_CAST(replace(regexp_extract(gapless, 'de ([0-9.,]+)(Euros|à[0-9])', 1), ',', '.') AS DOUBLE) AS salaire_min,
             TRY_CAST(replace(regexp_extract(gapless, 'à([0-9.,]+)Euros', 1), ',', '.') AS DOUBLE) AS salaire_max,
             coalesce(TRY_CAST(regexp_extract(salaire_libelle, 'sur ([0-9.]+) mois', 1) AS DOUBLE), 12) AS mois,
             {category_case("lower(intitule)")} AS categorie_metier
      FROM (SELECT *, regexp_replace(regexp_replace(replace(salaire_libelle, chr(160), ' '), '([0-9à]) +', '\\1', 'g'), ' +(à|Euros)', '\\1', 'g') AS gapless
            FROM france_travail)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY _ingestion_date DESC, dateCreation DESC) = 1)""",
    "regions": "SELECT code, nom, zone AS zone_geo FROM geo_regions",
    "departements": """
SELECT d.code, d.nom, d.codeRegion AS code_region, r.nom AS nom_region, d.zone AS zone_geo
FROM geo_departements d LEFT JOIN regions r ON d.codeRegion = r.code""",
    "communes": """
SELECT c.code, c.nom, c.codeDepartement AS code_departement, d.nom AS nom_departement, c.codeRegion AS code_region,
       r.nom AS nom_region, c.population, c.coordinates[2] AS centre_lat, c.coordinates[1] AS centre_lon
FROM geo_communes c LEFT JOIN departements d ON c.codeDepartement = d.code LEFT JOIN regions r ON c.codeRegion = r.code""",
    "bmo": f"""
SELECT CAST(annee AS BIGINT) AS annee, "Code métier BMO" AS code_metier_bmo, "Nom métier BMO" AS libelle_metier_bmo,
       "Famille_met" AS code_famille_metier, "Lbl_fam_met" AS libelle_famille_metier, "REG" AS code_region,
       "NOM_REG" AS nom_region, "Dept" AS code_departement, "NomDept" AS nom_departement, "BE25" AS code_bassin_emploi,
       "NOMBE25" AS libelle_bassin_emploi, CAST(nullif(met, '*') AS BIGINT) AS projets_recrutement,
       CAST(nullif(xmet, '*') AS BIGINT) AS projets_difficiles, CAST(nullif(smet, '*') AS BIGINT) AS projets_saisonniers
FROM bmo_survey WHERE "Code métier BMO" IN {_in(BMO_CODES)}""",
    "stg_bmo": """
SELECT *, CASE WHEN projets_difficiles IS NOT NULL AND projets_recrutement > 0
               THEN round(projets_difficiles * CAST(100 AS DOUBLE) / projets_recrutement, 1) END AS part_difficile_pct
FROM bmo""",
    "urssaf_long": " UNION ALL ".join(
        f"""
SELECT code_commune, intitule_commune, code_departement, code_ape, CAST({y} AS BIGINT) AS annee,
       effectifs_salaries_{y} AS effectifs_salaries, nombre_d_etablissements_{y} AS nb_etablissements
FROM urssaf_wide WHERE code_ape IN {_in(APE_CODES)}
  AND NOT (effectifs_salaries_{y} IS NULL AND nombre_d_etablissements_{y} IS NULL)"""
        for y in YEARS
    ),
    "stg_urssaf": """
SELECT code_commune, intitule_commune, code_departement, code_ape, annee,
       coalesce(nb_etablissements, 0) AS nb_etablissements, coalesce(effectifs_salaries, 0) AS effectifs_salaries
FROM urssaf_long""",
    "stg_payroll": """
SELECT CAST(split_part(secteur_na88i, ' ', 1) AS BIGINT) AS code_na88,
       substr(secteur_na88i, strpos(secteur_na88i, ' ') + 1) AS libelle_na88, CAST(annee AS BIGINT) AS annee,
       nombre_d_etablissements AS nb_etablissements, effectifs_salaries_moyens, masse_salariale AS masse_salariale_brute
FROM payroll WHERE secteur_na88i LIKE '62%'""",
    "stg_sirene": """
SELECT siret, siren, denomination AS denomination_usuelle, enseigne, naf AS code_naf, tranche AS tranche_effectifs,
       commune AS code_commune, postal AS code_postal, libelle AS libelle_commune, creation AS date_creation,
       siege AS is_siege, diffusion = 'P' AS is_diffusion_partielle, employeur = 'O' AS is_employeur
FROM sirene WHERE etat = 'A'""",
    "enriched": f"""
SELECT f.offre_id, f.source, f.titre, f.date_creation, f.categorie_metier, f.entreprise_nom, f.salaire_annuel_min,
       f.salaire_annuel_max, c.nom AS nom_commune, coalesce(c.code_departement, d.code) AS code_departement,
       coalesce(c.nom_departement, d.nom) AS nom_departement, coalesce(c.code_region, d.code_region) AS code_region,
       coalesce(c.nom_region, d.nom_region) AS nom_region, f.place AS code_commune
FROM (SELECT *, {_CITY} AS place,
             CASE WHEN code_commune IS NULL THEN CASE WHEN localisation_libelle LIKE '__ - %' THEN left(localisation_libelle, 2) ELSE left(code_postal, 2) END
                  END AS dept
      FROM stg_france_travail) f
LEFT JOIN communes c ON c.code = f.place
LEFT JOIN departements d ON d.code = f.dept
WHERE f.is_metier_data
UNION ALL
SELECT a.offre_id, a.source, a.titre, a.date_creation, a.categorie_metier, a.entreprise_nom, a.salaire_annuel_min,
       a.salaire_annuel_max, NULL, d.code, d.nom, d.code_region, d.nom_region, NULL
FROM stg_adzuna a
LEFT JOIN departements d ON {_NAME.format("d.nom")} = {_NAME.format("a.departement_nom")}
WHERE a.is_metier_data""",
    "mart_offers": """
SELECT *, (coalesce(salaire_annuel_min, salaire_annuel_max) + coalesce(salaire_annuel_max, salaire_annuel_min)) / 2
            AS salaire_annuel_milieu,
       CAST(date_trunc('month', date_creation) AS DATE) AS mois_publication
FROM enriched""",
    "density": f"""
SELECT {_CITY} AS code_commune, max(left({_CITY}, 2)) AS code_departement, annee, CAST(sum(nb_etablissements) AS BIGINT) AS nb_etablissements,
       CAST(sum(effectifs_salaries) AS BIGINT) AS effectifs_salaries
FROM stg_urssaf GROUP BY {_CITY}, annee""",
    "tension": """
SELECT code_departement, annee, CAST(sum(projets_recrutement) AS BIGINT) AS projets_recrutement,
       CAST(sum(projets_difficiles) AS BIGINT) AS projets_difficiles,
       round(sum(projets_difficiles) FILTER (projets_recrutement IS NOT NULL) * CAST(100 AS DOUBLE)
             / nullif(sum(projets_recrutement) FILTER (projets_difficiles IS NOT NULL), 0), 1) AS taux_difficulte_pct
FROM stg_bmo GROUP BY 1, 2""",
}

# What each text reads, so that a query carries only the CTEs it needs.
_ORDER = {**INPUTS, **MODELS}


def _uses(sql: str) -> set[str]:
    words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split())
    return words & set(_ORDER)


def with_ctes(select: str) -> str:
    """``select`` preceded by the inputs and models it reads, directly or not."""
    needed, frontier = set(), _uses(select)
    while frontier:
        needed |= frontier
        frontier = set().union(*(_uses(_ORDER[name]) - {name} for name in frontier)) - needed
    ctes = [f"{name} AS ({_ORDER[name]})" for name in _ORDER if name in needed]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + select

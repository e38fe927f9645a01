"""Explicit schemas of the raw tables.

Every code is a STRING: inference would turn ``2A``-style codes, offer ids and postcodes
into numbers. Schemas are declared for all eight raw tables, so no load ever needs an
inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, LONG, DOUBLE = StringType(), LongType(), DoubleType()
BOOLEAN, DATE, TIMESTAMP = BooleanType(), DateType(), TimestampType()


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


def repeated(element: DataType) -> ArrayType:
    return ArrayType(element)


# Field names and types of the raw tables.
ADZUNA = record(
    offre_id=STRING,
    titre=STRING,
    description=STRING,
    date_creation=TIMESTAMP,
    entreprise_nom=STRING,
    localisation_libelle=STRING,
    localisation_area=repeated(STRING),
    latitude=DOUBLE,
    longitude=DOUBLE,
    salaire_min=DOUBLE,
    salaire_max=DOUBLE,
    salaire_est_estime=LONG,
    type_contrat=STRING,
    temps_travail=STRING,
    categorie_tag=STRING,
    categorie_libelle=STRING,
    redirect_url=STRING,
    _ingestion_date=DATE,
)

FRANCE_TRAVAIL = record(
    id=STRING,
    dateCreation=TIMESTAMP,
    dateActualisation=TIMESTAMP,
    intitule=STRING,
    description=STRING,
    romeCode=STRING,
    romeLibelle=STRING,
    appellationlibelle=STRING,
    natureContrat=STRING,
    typeContrat=STRING,
    typeContratLibelle=STRING,
    nombrePostes=LONG,
    experienceExige=STRING,
    experienceLibelle=STRING,
    experienceCommentaire=STRING,
    alternance=BOOLEAN,
    dureeTravailLibelle=STRING,
    dureeTravailLibelleConverti=STRING,
    complementExercice=STRING,
    deplacementCode=STRING,
    deplacementLibelle=STRING,
    qualificationCode=STRING,
    qualificationLibelle=STRING,
    secteurActivite=STRING,
    secteurActiviteLibelle=STRING,
    codeNAF=STRING,
    trancheEffectifEtab=STRING,
    accessibleTH=BOOLEAN,
    entrepriseAdaptee=BOOLEAN,
    employeurHandiEngage=BOOLEAN,
    offresManqueCandidats=BOOLEAN,
    lieuTravail=record(libelle=STRING, commune=STRING, codePostal=STRING, latitude=DOUBLE, longitude=DOUBLE),
    entreprise=record(nom=STRING, url=STRING, logo=STRING, entrepriseAdaptee=BOOLEAN, description=STRING),
    salaire=record(
        libelle=STRING,
        commentaire=STRING,
        complement1=STRING,
        complement2=STRING,
        listeComplements=repeated(record(libelle=STRING, code=STRING)),
    ),
    contact=record(
        nom=STRING,
        courriel=STRING,
        coordonnees1=STRING,
        coordonnees2=STRING,
        coordonnees3=STRING,
        urlPostulation=STRING,
    ),
    competences=repeated(record(code=STRING, exigence=STRING, libelle=STRING)),
    formations=repeated(
        record(codeFormation=STRING, commentaire=STRING, domaineLibelle=STRING, exigence=STRING, niveauLibelle=STRING)
    ),
    langues=repeated(record(exigence=STRING, libelle=STRING)),
    permis=repeated(record(exigence=STRING, libelle=STRING)),
    qualitesProfessionnelles=repeated(record(description=STRING, libelle=STRING)),
    contexteTravail=record(conditionsExercice=repeated(STRING), horaires=repeated(STRING)),
    origineOffre=record(
        origine=STRING,
        urlOrigine=STRING,
        partenaires=repeated(record(url=STRING, logo=STRING, nom=STRING)),
    ),
    agence=record(courriel=STRING),
    _ingestion_date=DATE,
)

GEO_REGIONS = record(nom=STRING, code=STRING, zone=STRING, _ingestion_date=DATE)

GEO_DEPARTEMENTS = record(nom=STRING, code=STRING, codeRegion=STRING, zone=STRING, _ingestion_date=DATE)

GEO_COMMUNES = record(
    nom=STRING,
    code=STRING,
    codeDepartement=STRING,
    codeRegion=STRING,
    codesPostaux=repeated(STRING),
    population=LONG,
    centre=record(type=STRING, coordinates=repeated(DOUBLE)),
    _ingestion_date=DATE,
)

URSSAF_EFFECTIFS = record(
    code_commune=STRING,
    intitule_commune=STRING,
    code_departement=STRING,
    code_ape=STRING,
    annee=LONG,
    nb_etablissements=LONG,
    effectifs_salaries=LONG,
    _ingestion_date=DATE,
)

BMO = record(
    annee=LONG,
    code_metier_bmo=STRING,
    libelle_metier_bmo=STRING,
    code_famille_metier=STRING,
    libelle_famille_metier=STRING,
    code_region=STRING,
    nom_region=STRING,
    code_departement=STRING,
    nom_departement=STRING,
    code_bassin_emploi=STRING,
    libelle_bassin_emploi=STRING,
    projets_recrutement=LONG,
    projets_difficiles=LONG,
    projets_saisonniers=LONG,
    _ingestion_date=DATE,
)

URSSAF_MASSE_SALARIALE = record(
    code_na88=LONG,
    libelle_na88=STRING,
    annee=LONG,
    nb_etablissements=LONG,
    effectifs_salaries_moyens=LONG,
    masse_salariale_brute=LONG,
    _ingestion_date=DATE,
)

RAW_TABLES: dict[str, StructType] = {
    "france_travail": FRANCE_TRAVAIL,
    "adzuna": ADZUNA,
    "geo_regions": GEO_REGIONS,
    "geo_departements": GEO_DEPARTEMENTS,
    "geo_communes": GEO_COMMUNES,
    "urssaf_effectifs": URSSAF_EFFECTIFS,
    "bmo": BMO,
    "urssaf_masse_salariale": URSSAF_MASSE_SALARIALE,
}

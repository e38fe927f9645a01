"""What each source does between its landed data and its raw table.

``*_rows`` functions are lazy transforms; ``load_*`` functions run one source end to end.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emploiscope import schemas
from emploiscope.functions.codes import label_after_code, leading_code, masked_number
from emploiscope.operators.latest import last_wins
from emploiscope.operators.reshape import keep_prefix, keep_values, project_paths, rename, unpivot_years
from emploiscope.plans.declared_checks import APE_CODES, BMO_CODES
from emploiscope.sources import sink
from emploiscope.sources.freshness import should_skip
from emploiscope.sources.scan import require_columns, scan, scan_json, scan_json_text

# Source path -> raw column of the offers with nested fields.
ADZUNA_PATHS = {
    "id": "offre_id",
    "title": "titre",
    "company.display_name": "entreprise_nom",
    "location.display_name": "localisation_libelle",
    "location.area": "localisation_area",
    "latitude": "latitude",
    "longitude": "longitude",
    "salary_min": "salaire_min",
    "salary_max": "salaire_max",
    "salary_is_predicted": "salaire_est_estime",
    "description": "description",
    "redirect_url": "redirect_url",
    "category.tag": "categorie_tag",
    "category.label": "categorie_libelle",
    "contract_type": "type_contrat",
    "contract_time": "temps_travail",
    "created": "date_creation",
}

ADZUNA_FIELDS = list(dict.fromkeys(source.split(".")[0] for source in ADZUNA_PATHS))

# Survey header -> raw column, in order; the three counts may be masked.
BMO_HEADERS = {
    "annee": "annee",
    "Code métier BMO": "code_metier_bmo",
    "Nom métier BMO": "libelle_metier_bmo",
    "Famille_met": "code_famille_metier",
    "Lbl_fam_met": "libelle_famille_metier",
    "REG": "code_region",
    "NOM_REG": "nom_region",
    "Dept": "code_departement",
    "NomDept": "nom_departement",
    "BE25": "code_bassin_emploi",
    "NOMBE25": "libelle_bassin_emploi",
    "met": "projets_recrutement",
    "xmet": "projets_difficiles",
    "smet": "projets_saisonniers",
}
BMO_COUNTS = ["projets_recrutement", "projets_difficiles", "projets_saisonniers"]

# Columns of the wide headcount table.
URSSAF_DIMENSIONS = ["code_commune", "intitule_commune", "code_departement", "code_ape"]
URSSAF_HEADCOUNT = ("effectifs_salaries_", "effectifs_salaries")
URSSAF_ESTABLISHMENTS = ("nombre_d_etablissements_", "nb_etablissements")

# Payroll field -> raw column, and the sector kept.
PAYROLL_FIELDS = {
    "annee": "annee",
    "nombre_d_etablissements": "nb_etablissements",
    "effectifs_salaries_moyens": "effectifs_salaries_moyens",
    "masse_salariale": "masse_salariale_brute",
}
PAYROLL_SECTOR = "62"


def adzuna_rows(offers: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Offers with nested fields as text -> flat typed raw columns, plus those of ``keep``."""
    types = {field.name: field.dataType for field in schemas.ADZUNA}
    flat = project_paths(offers, ADZUNA_PATHS, types, keep)
    return flat.select(*(name for name in schemas.ADZUNA.fieldNames() if name in flat.columns))


def with_line_order(lines: DataFrame, name: str) -> DataFrame:
    """``lines``, scanned from files and not yet shuffled, with the place of each line as column ``name``.

    Places compare as the lines stand: by file, by block of the file, and within a block by the order
    of reading, which is the order of the lines as one task reads a block from front to back. So the
    number of blocks and the task that gets one make no difference. Files follow each other by path.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return lines.select("*", place.alias(name))


def france_travail_rows(offers: DataFrame, order: Sequence[str]) -> DataFrame:
    """Every landed offer, the last occurrence of an id winning by the columns ``order``, nulls coming first."""
    return last_wins(offers, "id", order[0], order[1:]).drop(*order)


def urssaf_effectifs_rows(wide: DataFrame) -> DataFrame:
    """Sector rows of the wide headcount table, one per year that has a column."""
    kept = keep_values(wide, "code_ape", APE_CODES)
    return unpivot_years(kept, URSSAF_DIMENSIONS, URSSAF_HEADCOUNT, URSSAF_ESTABLISHMENTS)


def urssaf_effectifs_records(lines: DataFrame) -> DataFrame:
    """The same from JSON lines (column ``value``), the years found in each record's own fields."""
    record = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    fields = lines.select(record.alias("r"))
    dimensions = [F.col("r")[name].alias(name) for name in URSSAF_DIMENSIONS]
    kept = keep_values(fields.select("r", *dimensions), "code_ape", APE_CODES)
    prefix = URSSAF_HEADCOUNT[0]
    named = F.filter(F.map_keys("r"), lambda key: key.rlike(f"^{prefix}[0-9]{{4}}$"))
    long = kept.select("r", *URSSAF_DIMENSIONS, F.explode(named).alias("field"))
    year = F.right("field", F.lit(4))
    measures = {
        URSSAF_HEADCOUNT[1]: F.col("r")[F.col("field")],
        URSSAF_ESTABLISHMENTS[1]: F.col("r")[F.concat(F.lit(URSSAF_ESTABLISHMENTS[0]), year)],
    }
    out = long.select(*URSSAF_DIMENSIONS, year.cast("bigint").alias("annee"), *(v.cast("bigint").alias(k) for k, v in measures.items()))
    return out.filter(" or ".join(f"{name} is not null" for name in measures))


def urssaf_masse_salariale_rows(records: DataFrame) -> DataFrame:
    """Sector 62 payroll in year order, the sector split into code and label."""
    return payroll_columns(keep_prefix(records, "secteur_na88i", PAYROLL_SECTOR)).orderBy("annee")


def payroll_columns(records: DataFrame) -> DataFrame:
    sector = F.col("secteur_na88i")
    numbers = [F.col(source).cast("bigint").alias(target) for source, target in PAYROLL_FIELDS.items()]
    return records.select(leading_code(sector).alias("code_na88"), label_after_code(sector).alias("libelle_na88"), *numbers)


def bmo_rows(survey: DataFrame) -> DataFrame:
    """IT rows of the survey, renamed, masked counts NULL."""
    require_columns(survey, BMO_HEADERS)
    return bmo_columns(rename(keep_values(survey, "Code métier BMO", BMO_CODES), BMO_HEADERS))


def bmo_columns(renamed: DataFrame) -> DataFrame:
    types = {field.name: field.dataType for field in schemas.BMO}
    return renamed.select(
        *(
            (masked_number(F.col(name)) if name in BMO_COUNTS else F.col(name).cast(types[name])).alias(name)
            for name in renamed.columns
        )
    )


def load_adzuna(spark: SparkSession, path: str, run_date: datetime.date, table: str = "raw.adzuna", **target) -> None:
    """Append one day's offers to the date-partitioned raw table; an empty file is loaded too.

    Loading a date twice appends twice, unless ``once=True`` says that a date is one run.
    """
    rows = adzuna_rows(scan_json_text(spark, path, ADZUNA_FIELDS))
    _append(sink.stamp(rows, run_date, row_hash=True), table, run_date, **target)


def load_france_travail(
    spark: SparkSession, path: str, run_date: datetime.date, table: str = "raw.france_travail", **target
) -> None:
    """Append one day's offers, every one of them, deduplicated, to the date-partitioned raw table.

    Lines stand in fetch order. Where they carry it beside the offer (``sequence``), it goes before the
    place in the file; a line without it comes before those with it.
    """
    schema = schemas.record(
        **{f.name: f.dataType for f in schemas.FRANCE_TRAVAIL if f.name != sink.INGESTION_DATE},
        sequence=schemas.LONG,
    )
    offers = with_line_order(scan_json(spark, path, schema), "_place")
    rows = france_travail_rows(offers, ["sequence", "_place"])
    _append(sink.stamp(rows, run_date, row_hash=True), table, run_date, **target)


def _append(rows: DataFrame, table: str, run_date: datetime.date, once: bool = False, **target) -> None:
    """Append, or with ``once`` replace what an earlier attempt of the same run date wrote."""
    if once:
        sink.load_run(rows, table, run_date, **target)
    else:
        sink.load_table(rows, table, "WRITE_APPEND", partition_by=[sink.INGESTION_DATE], **target)


def load_geo(
    spark: SparkSession, paths: dict[str, str], run_date: datetime.date, layer: str = "raw", root: str | None = None
) -> None:
    """Replace the three geographic tables; ``paths`` maps regions/departements/communes to files.

    Tables go to folders of their name under ``root``, or to the layer's own folder.
    """
    for resource in ("regions", "departements", "communes"):
        table = f"geo_{resource}"
        rows = scan_json(spark, paths[resource], schemas.RAW_TABLES[table]).drop(sink.INGESTION_DATE)
        sink.load_table(sink.stamp(rows, run_date), f"{layer}.{table}", location=_under(root, table))


def _under(root: str | None, table: str) -> str | None:
    return f"{root.rstrip('/')}/{table}" if root else None


def load_urssaf_effectifs(
    spark: SparkSession,
    path: str,
    run_date: datetime.date,
    table: str = "raw.urssaf_effectifs",
    **target,
) -> None:
    """Replace the headcount table from the wide export, all years of every record."""
    rows = sink.stamp(urssaf_effectifs_records(spark.read.text(path)), run_date)
    sink.load_table(rows.select(*schemas.URSSAF_EFFECTIFS.fieldNames()), table, **target)


def load_urssaf_masse_salariale(
    spark: SparkSession, path: str, run_date: datetime.date, table: str = "raw.urssaf_masse_salariale", **target
) -> None:
    text = scan_json_text(spark, path, ["secteur_na88i", *PAYROLL_FIELDS])
    sink.load_table(sink.stamp(urssaf_masse_salariale_rows(text), run_date), table, **target)


def scan_survey(spark: SparkSession, path: str) -> DataFrame:
    """The survey from a delimited text with headers (``.csv``) or JSON lines, every cell as text, no inference.

    The headers are read first; a missing one is an error before any other job. An empty cell is NULL.
    """
    if path.rstrip("/").endswith(".csv"):
        survey = spark.read.option("header", True).option("inferSchema", False).csv(path)
        return require_columns(survey, BMO_HEADERS).select(*(F.col(f"`{name}`") for name in BMO_HEADERS))
    return require_columns(scan_json_text(spark, path, BMO_HEADERS), BMO_HEADERS)


def load_bmo(spark: SparkSession, path: str, run_date: datetime.date, table: str = "raw.bmo", **target) -> bool:
    """Replace the survey table from a landed file; without any IT row the old table is left alone."""
    survey = scan_survey(spark, path)
    return sink.load_table(sink.stamp(bmo_rows(survey), run_date), table, skip_if_empty=True, **target)


def load_sirene(
    spark: SparkSession,
    paths: dict[str, str],
    snapshots: str,
    now: datetime.datetime,
    layer: str = "raw",
    root: str | None = None,
) -> bool:
    """Replace both register tables from Parquet unless a recent snapshot is already landed.

    ``paths`` maps ``sirene_unite_legale`` and ``sirene_etablissement`` to files.
    """
    if should_skip(spark, snapshots, now):
        return False
    for table, path in paths.items():
        sink.load_table(scan(spark, path), f"{layer}.{table}", location=_under(root, table))
    return True

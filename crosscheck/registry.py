"""Every operator as a named query over the driver's tables, with its SQL where one exists."""

from __future__ import annotations

import atexit
import datetime
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from crosscheck import inputs
from crosscheck.models_sql import category_case, with_ctes
from emploiscope import schemas
from emploiscope.functions import codes, titles
from emploiscope.operators import grid, latest, quality, reshape
from emploiscope.plans import current_state, intermediate, landing, layers, marts, staging_views
from emploiscope.plans import staging_offers as offers
from emploiscope.plans import staging_territory as territory
from emploiscope.plans.declared_checks import APE_CODES, BMO_CODES, CHECKS, check_model
from emploiscope.session import apply_required, working_folder
from emploiscope.sources import sink
from emploiscope.sources.freshness import snapshot_age
from emploiscope.sources.scan import require_columns, scan

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_DATE = datetime.date(2026, 3, 20)


def with_work_folder(spark: SparkSession) -> SparkSession:
    """Give a local session without a shared folder one that ends with the process; a cluster must name its own."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="emploiscope-queries-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return spark


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL it must agree with."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(with_work_folder(apply_required(spark)), sf_dir)

        QUERIES[name] = run
        ORACLES[name] = with_ctes(sql)
        return function

    return register


def moment(column: str) -> Column:
    """A timestamp as text, the same in both engines."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def sql_moment(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


# Staged tables from the derived inputs.


def stg_adzuna(spark, sf):
    return offers.stg_adzuna__offres(inputs.adzuna(spark, sf))


def stg_france_travail(spark, sf):
    return offers.stg_france_travail__offres(inputs.france_travail(spark, sf))


def regions(spark, sf):
    return territory.stg_geo__regions(inputs.geo_regions(spark, sf))


def departements(spark, sf):
    return territory.stg_geo__departements(inputs.geo_departements(spark, sf), regions(spark, sf))


def communes(spark, sf):
    return territory.stg_geo__communes(inputs.geo_communes(spark, sf), departements(spark, sf), regions(spark, sf))


def raw_bmo(spark, sf):
    return landing.bmo_rows(inputs.bmo_survey(spark, sf))


def stg_bmo(spark, sf):
    return territory.stg_bmo__projets_recrutement(raw_bmo(spark, sf))


def stg_urssaf(spark, sf):
    return territory.stg_urssaf__effectifs_commune_ape(landing.urssaf_effectifs_rows(inputs.urssaf_wide(spark, sf)))


def stg_payroll(spark, sf):
    return territory.stg_urssaf__masse_salariale_na88(landing.urssaf_masse_salariale_rows(inputs.payroll(spark, sf)))


def stg_sirene(spark, sf):
    return territory.stg_sirene__etablissements(inputs.sirene(spark, sf))


def enriched(spark, sf):
    return intermediate.int_offres_enrichies(
        stg_adzuna(spark, sf), stg_france_travail(spark, sf), communes(spark, sf), departements(spark, sf)
    )


def mart_offers(spark, sf):
    return marts.mart_offres(enriched(spark, sf))


def density(spark, sf):
    return intermediate.int_densite_sectorielle_commune(stg_urssaf(spark, sf))


def tension(spark, sf):
    return intermediate.int_tensions_bassin_emploi(stg_bmo(spark, sf))


# Flagship.


@query(
    "flagship_category_salaries",
    """
SELECT categorie_metier, count(*) AS n_offres, count(pay) AS n_avec_salaire, median(pay) AS salaire_annuel_median
FROM (SELECT categorie_metier, (coalesce(salaire_annuel_min, salaire_annuel_max)
                                + coalesce(salaire_annuel_max, salaire_annuel_min)) / 2 AS pay FROM stg_adzuna)
GROUP BY 1""",
)
def flagship(spark, sf):
    """From raw snapshots to offers and median annual salary per job category."""
    return marts.category_salaries(stg_adzuna(spark, sf))


# A: scans.


@query(
    "a1_scan_by_extension",
    """
SELECT fmt, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS sum_id
FROM events, (SELECT unnest(['jsonl', 'parquet']) AS fmt) GROUP BY 1, 2""",
)
def a1(spark, sf):
    """The same rows landed in both formats and read back by extension."""
    rows = inputs.table(spark, sf, "events").select("event_id", "event_type")
    folder = working_folder(spark, "a1")
    sink.export_jsonl(rows, f"{folder}/events.jsonl")
    sink.load_path(rows, f"{folder}/events.PARQUET")
    schema = schemas.record(event_id=schemas.LONG, event_type=schemas.STRING)
    json = scan(spark, f"{folder}/events.jsonl", schema).withColumn("fmt", F.lit("jsonl"))
    parquet = scan(spark, f"{folder}/events.PARQUET").withColumn("fmt", F.lit("parquet"))
    both = json.unionByName(parquet)
    return both.groupBy("fmt", "event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("sum_id"))


@query(
    "a2_json_explicit_schema",
    f"""
SELECT CAST(event_id AS VARCHAR) AS id, event_id % 2 AS flag, value, {sql_moment("ts")},
       CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def a2(spark, sf):
    """Quoted numbers typed, an unknown field dropped, an absent one NULL."""
    rows = inputs.table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_id") % 2).cast("string").alias("flag"),
        "value",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.lit("x").alias("unknown"),
    )
    path = sink.export_jsonl(rows, f"{working_folder(spark, 'a2')}/events.jsonl")
    schema = schemas.record(
        id=schemas.STRING, flag=schemas.LONG, value=schemas.DOUBLE, ts=schemas.TIMESTAMP, absent=schemas.STRING
    )
    return scan(spark, path, schema).withColumn("ts", moment("ts"))


@query("a3_parquet_scan", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0")
def a3(spark, sf):
    return scan(spark, f"{sf}/customer.parquet").filter(F.col("c_acctbal") > 0).select("c_custkey", "c_mktsegment")


@query(
    "a4_nested_raw_schema",
    f"""
SELECT id, {sql_moment("dateCreation")}, intitule, commune, latitude, entreprise_nom, salaire_libelle, _ingestion_date,
       TRUE AS competences_absent
FROM france_travail""",
)
def a4(spark, sf):
    """Nested offers written as JSON lines and read with the full raw schema."""
    path = sink.export_jsonl(inputs.france_travail(spark, sf), f"{working_folder(spark, 'a4')}/offres.jsonl")
    return scan(spark, path, schemas.FRANCE_TRAVAIL).select(
        "id",
        moment("dateCreation"),
        "intitule",
        F.col("lieuTravail.commune").alias("commune"),
        F.col("lieuTravail.latitude").alias("latitude"),
        F.col("entreprise.nom").alias("entreprise_nom"),
        F.col("salaire.libelle").alias("salaire_libelle"),
        "_ingestion_date",
        F.col("competences").isNull().alias("competences_absent"),
    )


@query("a5_required_columns", 'SELECT annee, "BE25" AS be, met FROM bmo_survey')
def a5(spark, sf):
    survey = require_columns(inputs.bmo_survey(spark, sf), landing.BMO_HEADERS)
    return survey.select("annee", F.col("BE25").alias("be"), "met")


@query(
    "a6_snapshot_age",
    """
SELECT max(CAST(o_orderdate AS DATE)) AS newest, DATE '2001-08-20' - max(CAST(o_orderdate AS DATE)) AS age_days,
       DATE '2001-08-20' - max(CAST(o_orderdate AS DATE)) < 30 AS skip FROM orders""",
)
def a6(spark, sf):
    return snapshot_age(inputs.table(spark, sf, "orders"), "o_orderdate", datetime.date(2001, 8, 20))


# B: sinks, proven by writing and reading back.


def _by_status(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("sum_key"))


def _orders(spark, sf):
    return inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")


_BY_STATUS = "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_key FROM orders GROUP BY 1"


@query("b1_full_replace", _BY_STATUS)
def b1(spark, sf):
    """A second full replace leaves only its own rows."""
    path = working_folder(spark, "b1")
    sink.load_path(_orders(spark, sf).withColumn("o_orderstatus", F.lit("old")), path)
    sink.load_path(_orders(spark, sf), path)
    return _by_status(spark.read.parquet(path))


@query(
    "b2_append_snapshot",
    """
SELECT _ingestion_date, count(*) AS n
FROM orders, (SELECT unnest([DATE '2026-03-13', DATE '2026-03-20']) AS _ingestion_date) GROUP BY 1""",
)
def b2(spark, sf):
    path = working_folder(spark, "b2")
    for run_date in (datetime.date(2026, 3, 13), RUN_DATE):
        stamped = sink.stamp(_orders(spark, sf), run_date)
        sink.load_path(stamped, path, "WRITE_APPEND", partition_by=["_ingestion_date"])
    return spark.read.parquet(path).groupBy("_ingestion_date").agg(F.count("*").alias("n"))


@query(
    "b4_date_partitions",
    """
SELECT month, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_key
FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
WHERE month >= DATE '1997-01-01' GROUP BY 1""",
)
def b4(spark, sf):
    """Written by month, gathered per month, then read with partitions pruned."""
    path = working_folder(spark, "b4")
    monthly = _orders(spark, sf).withColumn("month", F.date_trunc("month", "o_orderdate").cast("date"))
    sink.load_path(monthly, path, partition_by=["month"], rebalance=True)
    recent = spark.read.parquet(path).filter(F.col("month") >= F.lit(datetime.date(1997, 1, 1)))
    return recent.groupBy("month").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("sum_key"))


@query(
    "b5_clustered",
    """
SELECT l_suppkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem WHERE l_suppkey BETWEEN 10 AND 60 GROUP BY 1""",
)
def b5(spark, sf):
    path = working_folder(spark, "b5")
    lines = inputs.table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    sink.load_path(lines, path, cluster_by=["l_suppkey", "l_partkey"])
    some = spark.read.parquet(path).filter(F.col("l_suppkey").between(10, 60))
    return some.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("b6_stamp", f"SELECT o_orderkey, {inputs.RUN_DATE_SQL} AS _ingestion_date FROM orders")
def b6(spark, sf):
    return sink.stamp(_orders(spark, sf).select("o_orderkey"), RUN_DATE)


@query(
    "b7_jsonl_export",
    """
SELECT '{"offre_id":"' || offre_id || '","titre":' || coalesce('"' || replace(titre, chr(9), '\\t') || '"', 'null')
       || ',"entreprise_nom":' || coalesce('"' || entreprise_nom || '"', 'null') || '}' AS line
FROM adzuna""",
)
def b7(spark, sf):
    """Exported lines as text: accents unescaped, NULL fields present."""
    rows = inputs.adzuna(spark, sf).select("offre_id", "titre", "entreprise_nom")
    path = sink.export_jsonl(rows, f"{working_folder(spark, 'b7')}/offres.jsonl")
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("b8_dated_path", "SELECT '2026-03-20' AS landed_on, count(*) AS n FROM orders")
def b8(spark, sf):
    path = sink.landing_path(working_folder(spark, "b8"), "orders", RUN_DATE, "orders.parquet")
    sink.load_path(_orders(spark, sf), path)
    day = F.regexp_extract("_metadata.file_path", "/orders/([0-9]{4}-[0-9]{2}-[0-9]{2})/orders.parquet/", 1)
    return spark.read.parquet(path).groupBy(day.alias("landed_on")).agg(F.count("*").alias("n"))


@query("b9_empty_input", _BY_STATUS)
def b9(spark, sf):
    """An empty replacement is skipped and the old rows stay."""
    path = working_folder(spark, "b9")
    sink.load_path(_orders(spark, sf), path)
    sink.load_path(_orders(spark, sf).filter("o_orderkey < 0"), path, skip_if_empty=True)
    return _by_status(spark.read.parquet(path))


@query("b10_layers", "SELECT kind, d.* FROM density d, (SELECT unnest(['view', 'staging', 'intermediate']) AS kind)")
def b10(spark, sf):
    """A model read back by name: a session view, ``staging.<model>`` and an intermediate table."""
    model, name = density(spark, sf), "crosscheck_densite"
    view = layers.materialise(model, "staging", name, {name: layers.VIEW})
    read = [view.withColumn("kind", F.lit("view"))]
    for layer in ("staging", "intermediate"):
        layers.materialise(model, layer, name, location=f"{working_folder(spark, 'b10')}/{name}")
        read.append(spark.table(f"{layer}.{name}").withColumn("kind", F.lit(layer)))
    return grid.concat_fetches(read)


@query(
    "b3_dispositions",
    """
SELECT step, o_orderstatus, n * times AS n, CAST(1 AS BIGINT) AS refused
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
     (SELECT unnest(['WRITE_TRUNCATE', 'WRITE_APPEND', 'WRITE_TRUNCATE again']) AS step, unnest([1, 2, 1]) AS times)""",
)
def b3(spark, sf):
    """Both dispositions written and read back; any other is refused and changes nothing."""
    refused, read = 0, []
    for step in ("WRITE_TRUNCATE", "WRITE_APPEND", "WRITE_TRUNCATE again"):
        path = working_folder(spark, "b3")
        sink.load_path(_orders(spark, sf), path, "WRITE_TRUNCATE")
        sink.load_path(_orders(spark, sf), path, step.split(" ")[0])
        try:
            sink.load_path(_orders(spark, sf), path, "WRITE_EMPTY")
        except ValueError:
            refused = 1
        counted = spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
        read.append(counted.select(F.lit(step).alias("step"), "o_orderstatus", "n", F.lit(refused).cast("bigint").alias("refused")))
    return grid.concat_fetches(read)


# C: ingestion-time transforms.


@query(
    "c1_nested_paths",
    """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing,
       CAST(NULL AS VARCHAR) AS deeper, CAST(NULL AS VARCHAR) AS not_an_object
FROM events""",
)
def c1(spark, sf):
    paths = {
        "event_id": "event_id",
        "props.k": "k",
        "props.none": "missing",
        "props.k.deeper": "deeper",
        "event_type.name": "not_an_object",
    }
    return reshape.project_paths(inputs.table(spark, sf, "events"), paths, {"event_id": schemas.LONG})


@query(
    "c1_adzuna_mapping",
    f"""
SELECT CAST(event_id AS VARCHAR) AS offre_id, event_type AS titre,
       CASE WHEN event_id % 3 = 0 THEN 'Société ' || user_id END AS entreprise_nom,
       CASE WHEN event_id % 4 <> 0 THEN 'Lieu ' || user_id END AS localisation_libelle,
       CASE WHEN event_id % 4 > 1 THEN 'France|Région ' || user_id END AS area,
       value AS salaire_min, event_id % 2 AS salaire_est_estime, {sql_moment("date_creation")},
       CAST(NULL AS VARCHAR) AS description
FROM (SELECT *, date_trunc('second', ts) AS date_creation FROM events)""",
)
def c1_adzuna(spark, sf):
    """Offers as nested text fields mapped to the raw columns."""
    key, user = F.col("event_id"), F.col("user_id").cast("string")
    named = F.struct(F.concat(F.lit("Lieu "), user).alias("display_name"))
    located = F.struct(
        F.concat(F.lit("Lieu "), user).alias("display_name"),
        F.array(F.lit("France"), F.concat(F.lit("Région "), user)).alias("area"),
    )
    fields = {
        "id": key.cast("string"),
        "title": F.col("event_type"),
        "company": F.when(key % 3 == 0, F.to_json(F.struct(F.concat(F.lit("Société "), user).alias("display_name")))).when(
            key % 3 == 1, "a text"
        ),
        "location": F.when(key % 4 == 1, F.to_json(named)).when(key % 4 > 1, F.to_json(located)),
        "salary_min": F.col("value").cast("string"),
        "salary_is_predicted": (key % 2).cast("string"),
        "created": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    absent = ["latitude", "longitude", "salary_max", "description", "redirect_url", "category", "contract_type", "contract_time"]
    text = inputs.table(spark, sf, "events").select(
        *(column.alias(name) for name, column in fields.items()),
        *(F.lit(None).cast("string").alias(name) for name in absent),
    )
    return landing.adzuna_rows(text).select(
        "offre_id",
        "titre",
        "entreprise_nom",
        "localisation_libelle",
        F.array_join("localisation_area", "|").alias("area"),
        "salaire_min",
        "salaire_est_estime",
        moment("date_creation"),
        "description",
    )


@query(
    "c2_last_wins",
    """
SELECT CAST(user_id AS BIGINT) AS user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def c2(spark, sf):
    events = inputs.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return latest.last_wins(events, "user_id", "event_id")


_GRID_SQL = (
    f"SELECT rome, departement FROM (SELECT unnest({inputs.sql_list(grid.ROME_CODES)}) AS rome)"
    f" CROSS JOIN (SELECT unnest({inputs.sql_list(grid.DEPARTEMENTS)}) AS departement)"
)


@query(
    "c3_grid_coverage",
    f"""
SELECT g.rome, g.departement, count(f.id) AS n_offers, count(f.id) >= 30 AS at_cap
FROM ({_GRID_SQL}) g LEFT JOIN fetches f ON f.rome = g.rome AND f.departement = g.departement GROUP BY 1, 2""",
)
def c3(spark, sf):
    return grid.grid_coverage(grid.request_grid(spark), inputs.fetches(spark, sf), cap=30)


@query(
    "c4_cap_per_cell",
    """
SELECT rome, departement, sequence, value FROM hot_fetches
QUALIFY row_number() OVER (PARTITION BY rome, departement ORDER BY sequence) <= 1150""",
)
def c4(spark, sf):
    return grid.cap_offers(inputs.hot_fetches(spark, sf), "sequence")


@query(
    "c5_job_code_filter",
    f"""
SELECT "Code métier BMO" AS code, "BE25" AS be, annee, met FROM bmo_survey
WHERE "Code métier BMO" IN ({", ".join(f"'{c}'" for c in BMO_CODES)})""",
)
def c5(spark, sf):
    kept = reshape.keep_values(inputs.bmo_survey(spark, sf), "Code métier BMO", BMO_CODES)
    return kept.select(F.col("Code métier BMO").alias("code"), F.col("BE25").alias("be"), "annee", "met")


@query(
    "c6_rename_headers",
    "SELECT "
    + ", ".join(f'"{source}" AS {target}' for source, target in landing.BMO_HEADERS.items())
    + " FROM bmo_survey",
)
def c6(spark, sf):
    return reshape.rename(inputs.bmo_survey(spark, sf), landing.BMO_HEADERS)


@query("c7_masked_numbers", "SELECT * FROM bmo")
def c7(spark, sf):
    return raw_bmo(spark, sf)


@query(
    "c8_activity_filter",
    f"""
SELECT code_commune, code_ape, effectifs_salaries_1997, nombre_d_etablissements_1997 FROM urssaf_wide
WHERE code_ape IN ({", ".join(f"'{c}'" for c in APE_CODES)})""",
)
def c8(spark, sf):
    return reshape.keep_values(inputs.urssaf_wide(spark, sf), "code_ape", APE_CODES).select(
        "code_commune", "code_ape", "effectifs_salaries_1997", "nombre_d_etablissements_1997"
    )


@query("c9_unpivot_years", "SELECT * FROM urssaf_long")
def c9(spark, sf):
    return landing.urssaf_effectifs_rows(inputs.urssaf_wide(spark, sf))


@query("c10_sector_prefix", "SELECT * FROM payroll WHERE secteur_na88i LIKE '62%' ORDER BY annee")
def c10(spark, sf):
    return reshape.keep_prefix(inputs.payroll(spark, sf), "secteur_na88i", "62").orderBy("annee")


@query(
    "c11_code_and_label",
    """
SELECT CAST(split_part(secteur_na88i, ' ', 1) AS BIGINT) AS code_na88,
       substr(secteur_na88i, strpos(secteur_na88i, ' ') + 1) AS libelle_na88, CAST(annee AS BIGINT) AS annee,
       nombre_d_etablissements AS nb_etablissements, effectifs_salaries_moyens, masse_salariale AS masse_salariale_brute
FROM payroll""",
)
def c11(spark, sf):
    return landing.payroll_columns(inputs.payroll(spark, sf))


@query(
    "c12_month_tag",
    """
SELECT event_id, strftime(utc, '%Y-%m-%d %H:%M:%S') AS utc, strftime(utc, '%Y-%m') AS month
FROM (SELECT event_id, date_trunc('second', ts) - to_hours(CASE event_id % 3 WHEN 2 THEN 2 ELSE 0 END) AS utc FROM events)""",
)
def c12(spark, sf):
    """ISO texts with Z, without an offset (UTC) and with +02:00."""
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    offset = F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 2, "+02:00").otherwise("")
    instants = inputs.table(spark, sf, "events").select(
        "event_id", codes.utc_timestamp(F.concat(local, offset)).alias("utc")
    )
    return instants.select("event_id", codes.month_tag(F.col("utc")).alias("month"), moment("utc"))


# D: staged offers, step by step. The steps run on every snapshot; d11 is the whole table.


def _typed(spark, sf):
    return offers.typed_offers(inputs.adzuna(spark, sf))


def _priced(spark, sf):
    return offers.with_annual_salary(_typed(spark, sf))


def _classified(spark, sf):
    return offers.with_category(_typed(spark, sf))


@query(
    "d1_latest_snapshot",
    f"SELECT offre_id, titre, _ingestion_date, {sql_moment('date_creation')}, redirect_url FROM latest_adzuna",
)
def d1(spark, sf):
    return offers.latest_offers(inputs.adzuna(spark, sf)).select(
        "offre_id", "titre", "_ingestion_date", moment("date_creation"), "redirect_url"
    )


@query(
    "d1_incremental_state",
    f"""
SELECT offre_id, titre, CAST(date_trunc('quarter', _ingestion_date) AS DATE) AS _ingestion_date, {sql_moment('date_creation')}, redirect_url
FROM latest_adzuna""",
)
def d1_state(spark, sf):
    """The newest rows kept as a table: quarters arrive out of order, and one is loaded again after it had lost rows."""
    raw = inputs.adzuna(spark, sf).withColumn("_ingestion_date", F.trunc("_ingestion_date", "quarter"))
    month = F.month("_ingestion_date")
    where, state = working_folder(spark, "d1_raw"), working_folder(spark, "d1_state")
    table = f"{LAYER}.d1_state"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {LAYER}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    by_date = {"partition_by": ["_ingestion_date"], "rebalance": True}
    for step in (month < 4, month > 4, (month == 4) & (F.col("offre_id").cast("bigint") % 3 > 0)):
        sink.load_path(raw.filter(step), where, "WRITE_APPEND", **by_date)
        current_state.absorb(spark, spark.read.parquet(where), table, "offre_id", _TIES, location=state)
    again = raw.filter(month == 4).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    again.partitionBy("_ingestion_date").parquet(where)
    current_state.absorb(spark, spark.read.parquet(where), table, "offre_id", _TIES, location=state)
    return spark.table(table).select("offre_id", "titre", "_ingestion_date", moment("date_creation"), "redirect_url")


_TIES = ["date_creation"]


def _step(columns: list[str]) -> str:
    return f"SELECT redirect_url, {', '.join(columns)} FROM raw_adzuna_enriched"


_D2 = ["offre_id", "source", "latitude", "longitude", "salaire_min", "salaire_max", "salaire_est_estime"]


@query("d2_typing", _step(_D2))
def d2(spark, sf):
    return _typed(spark, sf).select("redirect_url", *_D2)


@query("d3_area_access", _step(["region", "departement_nom"]))
def d3(spark, sf):
    return _typed(spark, sf).select("redirect_url", "region", "departement_nom")


@query("d4_salary_source", _step(["source_salaire"]))
def d4(spark, sf):
    return _typed(spark, sf).select("redirect_url", "source_salaire")


@query("d5_salary_period", _step(["salaire_min", "salaire_max", "salaire_periodicite_inferree"]))
def d5(spark, sf):
    return _priced(spark, sf).select("redirect_url", "salaire_min", "salaire_max", "salaire_periodicite_inferree")


@query("d6_period_flag", _step(["is_salaire_periodicite_inferree"]))
def d6(spark, sf):
    return _priced(spark, sf).select("redirect_url", "is_salaire_periodicite_inferree")


@query("d7_annual_salary", _step(["salaire_annuel_min", "salaire_annuel_max"]))
def d7(spark, sf):
    return _priced(spark, sf).select("redirect_url", "salaire_annuel_min", "salaire_annuel_max")


@query("d8_lower_title", _step(["titre_normalise"]))
def d8(spark, sf):
    return _typed(spark, sf).select("redirect_url", "titre_normalise")


@query("d9_job_category", _step(["titre", "categorie_metier"]))
def d9(spark, sf):
    return _classified(spark, sf).select("redirect_url", "titre", "categorie_metier")


@query(
    "d9_job_category_texts",
    f"""
SELECT doc_id, {category_case("text")} AS categorie_metier
FROM (SELECT doc_id, lower(concat_ws(' ', text, ({inputs.sql_list(inputs.TITLES)})[1 + doc_id % {len(inputs.TITLES)}])) AS text
      FROM documents)""",
)
def d9_texts(spark, sf):
    """The same patterns over whole documents, each with a title at its end."""
    titled = F.concat_ws(" ", "text", inputs.pick(inputs.TITLES, F.col("doc_id") % len(inputs.TITLES)))
    lowered = inputs.table(spark, sf, "documents").select("doc_id", titles.normalised_title(titled).alias("text"))
    return lowered.select("doc_id", titles.job_category(F.col("text")).alias("categorie_metier"))


@query("d10_flags", _step(["is_metier_data", "is_data_engineer"]))
def d10(spark, sf):
    return _classified(spark, sf).select("redirect_url", "is_metier_data", "is_data_engineer")


_STAGED = ", ".join(sql_moment(c) if c == "date_creation" else c for c in offers.ADZUNA_COLUMNS)


@query("d11_stg_adzuna", f"SELECT {_STAGED} FROM stg_adzuna")
def d11(spark, sf):
    return stg_adzuna(spark, sf).withColumn("date_creation", moment("date_creation"))


def _view(spark, sf, model, raw):
    """A staged model read by name through its persistent view over a raw table of the catalog."""
    table, _ = staging_views.VIEWS[model]
    sink.load_table(raw, f"crosscheck_raw.{table}", location=f"{working_folder(spark, 'b10_raw')}/{table}")
    staging_views.create_functions(spark, "crosscheck_staging")
    staging_views.create_view(spark, model, "crosscheck_raw", "crosscheck_staging")
    return spark.table(f"crosscheck_staging.{model}")


@query("b10_view_adzuna", f"SELECT {_STAGED} FROM stg_adzuna")
def b10_view_adzuna(spark, sf):
    return _view(spark, sf, "stg_adzuna__offres", inputs.adzuna(spark, sf)).withColumn("date_creation", moment("date_creation"))


# E: other staged tables.


@query("e1_stg_bmo", "SELECT * FROM stg_bmo")
def e1(spark, sf):
    return stg_bmo(spark, sf)


@query("e2_stg_regions", "SELECT * FROM regions")
def e2(spark, sf):
    return regions(spark, sf)


@query("e3_stg_departements", "SELECT * FROM departements")
def e3(spark, sf):
    return departements(spark, sf)


@query(
    "e4_stg_communes",
    "SELECT code, nom, code_departement, nom_departement, code_region, nom_region, population FROM communes",
)
def e4(spark, sf):
    return communes(spark, sf).drop("centre_lat", "centre_lon")


@query("e5_commune_centres", "SELECT code, centre_lat, centre_lon FROM communes")
def e5(spark, sf):
    return communes(spark, sf).select("code", "centre_lat", "centre_lon")


@query("e6_active_establishments", "SELECT siret, etat FROM sirene WHERE etat = 'A'")
def e6(spark, sf):
    active = territory.active_establishments(inputs.sirene(spark, sf))
    return active.select("siret", F.col("etatAdministratifEtablissement").alias("etat"))


@query("e7_stg_sirene", "SELECT * FROM stg_sirene")
def e7(spark, sf):
    return stg_sirene(spark, sf)


@query("e8_stg_urssaf", "SELECT * FROM stg_urssaf")
def e8(spark, sf):
    return stg_urssaf(spark, sf)


_FT_COLUMNS = [
    "offre_id",
    "titre",
    "description",
    "date_creation",
    "source",
    "code_rome",
    "categorie_metier",
    "is_metier_data",
    "is_data_engineer",
    "entreprise_nom",
    "localisation_libelle",
    "code_commune",
    "code_postal",
    "latitude",
    "longitude",
    "salaire_libelle",
    "salaire_periodicite",
    "salaire_min",
    "salaire_max",
    "source_salaire",
    "salaire_annuel_min",
    "salaire_annuel_max",
    "type_contrat",
    "temps_travail",
]


_STAGED_FT = ", ".join(sql_moment(c) if c == "date_creation" else c for c in _FT_COLUMNS)


@query("e9_stg_france_travail", f"SELECT {_STAGED_FT} FROM stg_france_travail")
def e9(spark, sf):
    return stg_france_travail(spark, sf).withColumn("date_creation", moment("date_creation")).select(*_FT_COLUMNS)


@query("b10_view_france_travail", f"SELECT {_STAGED_FT} FROM stg_france_travail")
def b10_view_france_travail(spark, sf):
    view = _view(spark, sf, "stg_france_travail__offres", inputs.france_travail(spark, sf))
    return view.withColumn("date_creation", moment("date_creation")).select(*_FT_COLUMNS)


@query("e10_stg_payroll", "SELECT * FROM stg_payroll")
def e10(spark, sf):
    return stg_payroll(spark, sf)


# F: intermediate tables and marts.

_ENRICHED = [
    "offre_id",
    "source",
    "titre",
    "categorie_metier",
    "entreprise_nom",
    "salaire_annuel_min",
    "salaire_annuel_max",
    "code_commune",
    "nom_commune",
    "code_departement",
    "nom_departement",
    "code_region",
    "nom_region",
]


@query("f1_int_offres_enrichies", f"SELECT {', '.join(_ENRICHED)} FROM enriched")
def f1(spark, sf):
    return enriched(spark, sf).select(*_ENRICHED)


@query(
    "f1_nearest_commune",
    """
SELECT offre_id, code AS code_commune FROM stg_adzuna LEFT JOIN (
    SELECT latitude, longitude, code
    FROM (SELECT DISTINCT latitude, longitude FROM stg_adzuna WHERE abs(latitude) <= 90 AND abs(longitude) <= 180), communes
    WHERE abs(centre_lat) <= 90 AND abs(centre_lon) <= 180
    QUALIFY row_number() OVER (PARTITION BY latitude, longitude
                               ORDER BY pow((centre_lon - longitude) * cos(radians(latitude)), 2) + pow(centre_lat - latitude, 2), code) = 1
) USING (latitude, longitude)""",
)
def f1_nearest(spark, sf):
    """The commune whose centre is nearest to an offer's coordinates, against all pairs."""
    return intermediate.with_nearest_commune(stg_adzuna(spark, sf), communes(spark, sf)).select("offre_id", "code_commune")


@query(
    "f1_unplaced_offers",
    """
SELECT source, count(*) AS n_offres, count(*) FILTER (code_departement IS NULL) AS n_sans_departement
FROM enriched GROUP BY 1""",
)
def f1_unplaced(spark, sf):
    return intermediate.unplaced_offers(enriched(spark, sf))


@query(
    "f2_paris_commune",
    """
SELECT code, CASE WHEN code BETWEEN '75101' AND '75120' AND length(code) = 5 THEN '75056' ELSE code END AS city
FROM geo_communes""",
)
def f2(spark, sf):
    return inputs.geo_communes(spark, sf).select("code", codes.city_commune(F.col("code")).alias("city"))


@query("f3_int_densite", "SELECT * FROM density")
def f3(spark, sf):
    return density(spark, sf)


@query("f4_int_tensions", "SELECT * FROM tension")
def f4(spark, sf):
    return tension(spark, sf)


@query(
    "f5_mart_offres",
    "SELECT offre_id, source, nom_region, salaire_annuel_milieu, mois_publication FROM mart_offers",
)
def f5(spark, sf):
    return mart_offers(spark, sf).select("offre_id", "source", "nom_region", "salaire_annuel_milieu", "mois_publication")


@query(
    "f6_mart_contexte_territorial",
    """
SELECT annee, code_departement, nb_communes, nb_etablissements, effectifs_salaries, projets_recrutement,
       projets_difficiles, taux_difficulte_pct, salaire_moyen_national
FROM (SELECT code_departement, annee, count(*) AS nb_communes,
             CAST(sum(nb_etablissements) AS BIGINT) AS nb_etablissements,
             CAST(sum(effectifs_salaries) AS BIGINT) AS effectifs_salaries FROM density GROUP BY 1, 2)
FULL JOIN tension USING (code_departement, annee)
LEFT JOIN (SELECT annee, round(sum(masse_salariale_brute) / CAST(sum(effectifs_salaries_moyens) AS DOUBLE), 2)
                  AS salaire_moyen_national FROM stg_payroll GROUP BY 1) USING (annee)""",
)
def f6(spark, sf):
    return marts.mart_contexte_territorial(density(spark, sf), tension(spark, sf), stg_payroll(spark, sf))


@query(
    "f7_region_summary",
    """
SELECT nom_region, count(*) AS n_offres, count(DISTINCT entreprise_nom) AS n_entreprises,
       median(salaire_annuel_milieu) AS salaire_annuel_median FROM mart_offers GROUP BY 1""",
)
def f7(spark, sf):
    return marts.region_summary(mart_offers(spark, sf))


@query(
    "f7_top_companies",
    """
SELECT * FROM (SELECT nom_region, entreprise_nom, count(*) AS n_offres FROM mart_offers
               WHERE entreprise_nom IS NOT NULL GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY nom_region ORDER BY n_offres DESC, entreprise_nom) <= 10""",
)
def f7_top(spark, sf):
    return marts.top_companies(mart_offers(spark, sf))


# Whole loads, from landed files to a raw table read back by name.


# Not "raw": a query must never touch a table someone uses.
LAYER = "crosscheck_raw"


def _raw(spark: SparkSession, table: str, write: Callable[[str, str], object]) -> DataFrame:
    """Let ``write`` fill a new table, given its name and folder; a former one is forgotten first."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {LAYER}")
    spark.sql(f"DROP TABLE IF EXISTS {LAYER}.{table}")
    write(f"{LAYER}.{table}", working_folder(spark, table))
    return spark.table(f"{LAYER}.{table}")


def _landed(spark: SparkSession, rows: DataFrame, source: str) -> str:
    path = sink.landing_path(working_folder(spark, "landing"), source, RUN_DATE, f"{source}.jsonl")
    return sink.export_jsonl(rows, path)


@query(
    "load_adzuna",
    f"""
SELECT CAST(event_id AS VARCHAR) AS offre_id, event_type AS titre, 'Société ' || user_id AS entreprise_nom,
       CASE WHEN event_id % 2 = 0 THEN 'France|Région ' || user_id END AS area, value AS salaire_min,
       event_id % 2 AS salaire_est_estime, {inputs.RUN_DATE_SQL} AS _ingestion_date
FROM events""",
)
def load_adzuna(spark, sf):
    key, user = F.col("event_id"), F.col("user_id").cast("string")
    area = F.array(F.lit("France"), F.concat(F.lit("Région "), user))
    rows = inputs.table(spark, sf, "events").select(
        key.alias("id"),
        F.col("event_type").alias("title"),
        F.struct(F.concat(F.lit("Société "), user).alias("display_name"), F.lit("C").alias("__CLASS__")).alias("company"),
        F.struct(F.when(key % 2 == 0, area).alias("area")).alias("location"),
        F.col("value").alias("salary_min"),
        (key % 2).cast("string").alias("salary_is_predicted"),
        F.lit("dropped").alias("adref"),
    )
    path = _landed(spark, rows, "adzuna")
    table = _raw(spark, "adzuna", lambda name, where: landing.load_adzuna(spark, path, RUN_DATE, name, location=where))
    return table.select(
        "offre_id",
        "titre",
        "entreprise_nom",
        F.array_join("localisation_area", "|").alias("area"),
        "salaire_min",
        "salaire_est_estime",
        "_ingestion_date",
    )


@query(
    "load_france_travail",
    f"""
SELECT id, intitule, commune, salaire_libelle, {inputs.RUN_DATE_SQL} AS _ingestion_date
FROM france_travail QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1""",
)
def load_france_travail(spark, sf):
    """All offers, thousands of them under one job code; the last fetch of an id is kept."""
    rows = inputs.france_travail(spark, sf).drop("_ingestion_date").withColumnRenamed("event_id", "sequence")
    path = _landed(spark, rows, "france_travail")
    table = _raw(
        spark,
        "france_travail",
        lambda name, where: landing.load_france_travail(spark, path, RUN_DATE, name, location=where),
    )
    return table.select(
        "id",
        "intitule",
        F.col("lieuTravail.commune").alias("commune"),
        F.col("salaire.libelle").alias("salaire_libelle"),
        "_ingestion_date",
    )


@query(
    "load_france_travail_lines",
    f"""
SELECT id, intitule, {inputs.RUN_DATE_SQL} AS _ingestion_date
FROM france_travail QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1""",
)
def load_france_travail_lines(spark, sf):
    """Files without a fetch order beside the offer: the last line of an id is kept."""
    ordered = inputs.france_travail(spark, sf).drop("_ingestion_date").orderBy("event_id").drop("event_id")
    path = _landed(spark, ordered, "france_travail_lines")
    table = _raw(
        spark,
        "france_travail_lines",
        lambda name, where: landing.load_france_travail(spark, path, RUN_DATE, name, location=where),
    )
    return table.select("id", "intitule", "_ingestion_date")


@query(
    "b2_run_again",
    """
SELECT _ingestion_date, count(*) AS n, CAST(2 AS BIGINT) AS finished
FROM orders, (SELECT unnest([DATE '2026-03-13', DATE '2026-03-20']) AS _ingestion_date) GROUP BY 1""",
)
def b2_run_again(spark, sf):
    """Two daily runs, the second one started twice: one copy of each."""

    def run(name, where):
        for run_date in (datetime.date(2026, 3, 13), RUN_DATE, RUN_DATE):
            sink.load_run(sink.stamp(_orders(spark, sf), run_date), name, run_date, location=where)
        finished.append(len(sink.finished_runs(spark, name)))

    finished: list[int] = []
    table = _raw(spark, "run_again", run)
    return table.groupBy("_ingestion_date").agg(F.count("*").alias("n")).withColumn("finished", F.lit(finished[0]).cast("bigint"))


@query(
    "load_geo",
    f"""
SELECT 'communes' AS resource, code, nom, codeDepartement AS parent, population, {inputs.RUN_DATE_SQL} AS _ingestion_date
FROM geo_communes
UNION ALL SELECT 'departements', code, nom, codeRegion, NULL, {inputs.RUN_DATE_SQL} FROM geo_departements
UNION ALL SELECT 'regions', code, nom, NULL, NULL, {inputs.RUN_DATE_SQL} FROM geo_regions""",
)
def load_geo(spark, sf):
    sources = {
        "communes": inputs.geo_communes(spark, sf).withColumn("surface", F.lit(1.0)),
        "departements": inputs.geo_departements(spark, sf),
        "regions": inputs.geo_regions(spark, sf),
    }
    paths = {name: _landed(spark, rows, name) for name, rows in sources.items()}
    landing.load_geo(spark, paths, RUN_DATE, LAYER, root=working_folder(spark, "geo"))
    parents = {"communes": F.col("codeDepartement"), "departements": F.col("codeRegion"), "regions": F.lit(None)}
    loaded = [
        spark.table(f"{LAYER}.geo_{name}").select(
            F.lit(name).alias("resource"),
            "code",
            "nom",
            parent.cast("string").alias("parent"),
            (F.col("population") if name == "communes" else F.lit(None).cast("bigint")).alias("population"),
            "_ingestion_date",
        )
        for name, parent in parents.items()
    ]
    return grid.concat_fetches(loaded)


@query("load_urssaf_effectifs", f"SELECT *, {inputs.RUN_DATE_SQL} AS _ingestion_date FROM urssaf_long")
def load_urssaf_effectifs(spark, sf):
    path = _landed(spark, inputs.urssaf_wide(spark, sf), "urssaf_effectifs")
    return _raw(
        spark,
        "urssaf_effectifs",
        lambda name, where: landing.load_urssaf_effectifs(spark, path, RUN_DATE, name, location=where),
    )


@query(
    "load_urssaf_years_per_record",
    f"""
SELECT '31555' AS code_commune, 'Commune ' || l_suppkey AS intitule_commune, '31' AS code_departement, '6201Z' AS code_ape,
       CAST(year(l_shipdate) AS BIGINT) AS annee, CAST(count(*) AS BIGINT) AS effectifs_salaries,
       CASE WHEN l_suppkey % 2 = 0 THEN CAST(1 AS BIGINT) END AS nb_etablissements, {inputs.RUN_DATE_SQL} AS _ingestion_date
FROM lineitem GROUP BY l_suppkey, year(l_shipdate)""",
)
def load_urssaf_years(spark, sf):
    """Records that each hold a year of their own; no year is named beforehand."""
    supplier, year = F.col("l_suppkey"), F.year("l_shipdate").cast("string")
    counted = inputs.table(spark, sf, "lineitem").groupBy(supplier, year.alias("y")).agg(F.count("*").cast("string").alias("n"))
    fields = F.create_map(
        *[F.lit("code_commune"), F.lit("31555"), F.lit("intitule_commune"), F.concat(F.lit("Commune "), supplier.cast("string"))],
        *[F.lit("code_departement"), F.lit("31"), F.lit("code_ape"), F.lit("6201Z")],
        *[F.concat(F.lit("effectifs_salaries_"), "y"), F.col("n")],
        *[F.concat(F.lit("nombre_d_etablissements_"), "y"), F.when(supplier % 2 == 0, "1")],
    )
    path = sink.landing_path(working_folder(spark, "landing"), "urssaf_effectifs", RUN_DATE, "lines.jsonl")
    counted.select(F.to_json(fields).alias("value")).write.text(path)
    return _raw(spark, "urssaf_years", lambda name, where: landing.load_urssaf_effectifs(spark, path, RUN_DATE, name, location=where))


@query("load_urssaf_masse_salariale", f"SELECT *, {inputs.RUN_DATE_SQL} AS _ingestion_date FROM stg_payroll")
def load_urssaf_masse_salariale(spark, sf):
    path = _landed(spark, inputs.payroll(spark, sf), "urssaf_masse_salariale")
    return _raw(
        spark,
        "urssaf_masse_salariale",
        lambda name, where: landing.load_urssaf_masse_salariale(spark, path, RUN_DATE, name, location=where),
    )


@query("load_bmo", f"SELECT *, {inputs.RUN_DATE_SQL} AS _ingestion_date FROM bmo")
def load_bmo(spark, sf):
    """The survey loaded, then an empty one that leaves the table alone."""

    def write(name: str, where: str) -> None:
        survey = inputs.bmo_survey(spark, sf)
        landing.load_bmo(spark, _landed(spark, survey, "bmo"), RUN_DATE, name, location=where)
        landing.load_bmo(spark, _landed(spark, survey.filter(F.col("annee") == "none"), "bmo"), RUN_DATE, name, location=where)

    return _raw(spark, "bmo", write)


@query(
    "load_sirene",
    """
SELECT kind, siret, etat FROM sirene, (SELECT unnest(['sirene_etablissement', 'sirene_unite_legale']) AS kind)""",
)
def load_sirene(spark, sf):
    """Both register tables from Parquet, as no snapshot is recent."""
    folder = working_folder(spark, "sirene")
    sink.load_path(inputs.sirene(spark, sf), f"{folder}/stock.parquet")
    tables = ["sirene_etablissement", "sirene_unite_legale"]
    now = datetime.datetime.now(datetime.UTC)
    paths = dict.fromkeys(tables, f"{folder}/stock.parquet")
    landing.load_sirene(spark, paths, f"{folder}/snapshots", now, LAYER, root=f"{folder}/raw")
    loaded = [
        spark.table(f"{LAYER}.{name}").select(
            F.lit(name).alias("kind"), "siret", F.col("etatAdministratifEtablissement").alias("etat")
        )
        for name in tables
    ]
    return grid.concat_fetches(loaded)


# G: checks, one operator at a time and as declared on each table.


def check_sql(model: str, source: str, check: quality.Check, parents: dict[str, str]) -> str:
    column = check.columns[0]
    rows = f"(SELECT * FROM {source} WHERE {check.where or 'TRUE'})"
    label = f"'{model}' AS model, '{check.label}' AS \"column\", '{check.test}' AS test, '{check.severity}' AS severity"
    if check.test == "not_null":
        failures = f"(SELECT count(*) FROM {rows} WHERE {column} IS NULL)"
    elif check.test == "accepted_values":
        accepted = ", ".join(str(v).upper() if isinstance(v, bool) else f"'{v}'" for v in check.values)
        failures = f"(SELECT count(DISTINCT {column}) FROM {rows} WHERE {column} NOT IN ({accepted}))"
    elif check.test == "relationships":
        parent = f"(SELECT {check.field} FROM {parents[check.to]})"
        failures = f"(SELECT count(*) FROM {rows} WHERE {column} IS NOT NULL AND {column} NOT IN {parent})"
    else:
        keep = f"{column} IS NOT NULL" if check.test == "unique" else "TRUE"
        keys = ", ".join(check.columns)
        failures = f"(SELECT count(*) FROM (SELECT {keys} FROM {rows} WHERE {keep} GROUP BY {keys} HAVING count(*) > 1))"
    return f"SELECT {label}, {failures} AS failures"


def checks_query(
    name: str,
    model: str,
    source: str,
    build: Query,
    checks: list[quality.Check],
    parents: dict[str, tuple[str, Query]] | None = None,
) -> None:
    """Register the report of ``checks`` on one table."""
    parents = parents or {}
    texts = [check_sql(model, source, check, {to: text for to, (text, _) in parents.items()}) for check in checks]

    @query(name, " UNION ALL ".join(texts))
    def run(spark, sf):
        tables = {to: parent(spark, sf) for to, (_, parent) in parents.items()}
        return quality.run_checks(build(spark, sf), model, checks, tables)


_GEO_PARENTS = {"stg_geo__departements": ("departements", departements), "stg_geo__regions": ("regions", regions)}

checks_query("g1_not_null", "communes", "communes", communes, [quality.not_null("code_departement")])
checks_query(
    "g2_unique",
    "lineitem",
    "lineitem",
    lambda spark, sf: inputs.table(spark, sf, "lineitem"),
    [quality.unique("l_orderkey")],
)
checks_query(
    "g3_accepted_values",
    "offers",
    "stg_adzuna",
    stg_adzuna,
    [quality.accepted_values("categorie_metier", ["autre_it", "data_engineer"])],
)
checks_query(
    "g4_relationships",
    "communes",
    "communes",
    communes,
    [quality.relationships("code_departement", "stg_geo__departements", "code")],
    _GEO_PARENTS,
)
checks_query(
    "g5_unique_combination",
    "lineitem",
    "lineitem",
    lambda spark, sf: inputs.table(spark, sf, "lineitem"),
    [quality.unique_combination("l_orderkey", "l_linenumber")],
)
checks_query(
    "g6_where_and_severity",
    "sirene",
    "stg_sirene",
    stg_sirene,
    [
        quality.not_null("code_commune", severity=quality.WARN),
        quality.not_null("code_commune", where="is_siege"),
        quality.accepted_values("is_employeur", [True], where="is_diffusion_partielle"),
        quality.unique("siren", where="is_siege", severity=quality.WARN),
    ],
)

for _model, _source, _build in [
    ("stg_adzuna__offres", "stg_adzuna", stg_adzuna),
    ("stg_geo__regions", "regions", regions),
    ("stg_geo__departements", "departements", departements),
    ("stg_geo__communes", "communes", communes),
    ("stg_bmo__projets_recrutement", "stg_bmo", stg_bmo),
    ("stg_urssaf__effectifs_commune_ape", "stg_urssaf", stg_urssaf),
    ("stg_sirene__etablissements", "stg_sirene", stg_sirene),
]:
    checks_query(f"checks_{_model}", _model, _source, _build, CHECKS[_model], _GEO_PARENTS)

import datetime
import json
import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emploiscope import schemas
from emploiscope.plans import landing
from emploiscope.sources import freshness, sink
from emploiscope.sources.scan import require_columns, scan, scan_json, scan_json_text, source_format

DAY = datetime.date(2026, 3, 20)


def write_lines(path: Path, *records) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = (r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records)
    path.write_text("\n".join(lines), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize(
    "path, expected",
    [("a/b.json", "json"), ("a/b.JSONL", "json"), ("a/b.parquet", "parquet"), ("a/b.Parquet/", "parquet")],
)
def test_source_format(path, expected):
    assert source_format(path) == expected


@pytest.mark.parametrize("path", ["a/b.csv", "a/b", "a/jsonl"])
def test_source_format_rejects_others(path):
    with pytest.raises(ValueError, match="No reader for"):
        source_format(path)


def test_scan_json_types_and_fields(spark, tmp_path):
    path = write_lines(
        tmp_path / "x.jsonl",
        {"id": 42, "n": "0", "code": "2A", "extra": 1, "d": "2026-03-20", "ok": True},
        {"id": "7", "n": 3, "code": 59},
    )
    schema = schemas.record(
        id=schemas.STRING, n=schemas.LONG, code=schemas.STRING, d=schemas.DATE, ok=schemas.BOOLEAN, gone=schemas.DOUBLE
    )
    df = scan(spark, path, schema)
    assert df.schema == schema
    assert sorted(map(tuple, df.collect())) == [("42", 0, "2A", DAY, True, None), ("7", 3, "59", None, None, None)]


def test_scan_json_rejects_wrong_numbers_and_bad_lines(spark, tmp_path):
    path = write_lines(tmp_path / "n.jsonl", {"n": "many"})
    with pytest.raises(PySparkException):
        scan(spark, path, schemas.record(n=schemas.LONG)).collect()
    path = write_lines(tmp_path / "b.jsonl", '{"n": 1}', "not json")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        scan(spark, path, schemas.record(n=schemas.LONG)).collect()


def test_nested_schema(spark, tmp_path):
    offer = {
        "id": "A1",
        "dateCreation": "2026-03-20T07:53:25.000Z",
        "intitule": "Ingénieur données",
        "nombrePostes": "2",
        "alternance": False,
        "lieuTravail": {"libelle": "59 - Lille", "commune": "59350", "codePostal": 59000, "latitude": "50.6", "longitude": 3.0},
        "salaire": {"libelle": "x", "listeComplements": [{"libelle": "Prime", "code": 4}]},
        "competences": [{"code": 103, "libelle": "SQL"}, {"libelle": "Spark", "exigence": "E"}],
        "contexteTravail": {"horaires": ["35H"]},
        "agence": None,
        "unknown": {"a": 1},
    }
    df = scan(spark, write_lines(tmp_path / "ft.jsonl", offer), schemas.FRANCE_TRAVAIL)
    assert df.schema.simpleString() == schemas.FRANCE_TRAVAIL.simpleString()
    row = df.first()
    assert row["lieuTravail"].asDict() == {
        "libelle": "59 - Lille", "commune": "59350", "codePostal": "59000", "latitude": 50.6, "longitude": 3.0
    }
    assert [c["code"] for c in row["competences"]] == ["103", None]
    assert row["salaire"]["listeComplements"][0]["code"] == "4"
    assert (row["nombrePostes"], row["alternance"], row["agence"], row["contact"]) == (2, False, None, None)
    assert row["contexteTravail"]["horaires"] == ["35H"]


def test_a_scalar_is_no_record(spark, tmp_path):
    path = write_lines(tmp_path / "ft.jsonl", {"id": "A1", "agence": "text instead of an object"})
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED_RECORD"):
        scan(spark, path, schemas.FRANCE_TRAVAIL).select("id", "agence").collect()


@pytest.mark.parametrize("table", schemas.RAW_TABLES)
def test_every_raw_schema_reads_an_empty_object(spark, tmp_path, table):
    schema = schemas.RAW_TABLES[table]
    df = scan(spark, write_lines(tmp_path / "e.json", {}), schema)
    assert df.columns == schema.fieldNames()
    assert all(value is None for value in df.first())


def test_parquet_keeps_its_schema(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).withColumn("s", F.lit("2A")).write.parquet(path)
    assert scan(spark, path).dtypes == [("id", "bigint"), ("s", "string")]
    assert scan(spark, path, schemas.record(id=schemas.STRING)).dtypes == [("id", "string")]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "annee int, met int")
    assert require_columns(df, ["annee"]) is df
    with pytest.raises(ValueError, match=r"Missing columns: \['xmet', 'smet'\].*'annee', 'met'"):
        require_columns(df, ["annee", "xmet", "smet"])


def test_unknown_disposition(spark, tmp_path):
    with pytest.raises(ValueError, match="Unknown write disposition"):
        sink.load_path(spark.range(1), str(tmp_path / "x"), "WRITE_MERGE")
    with pytest.raises(ValueError, match="Unknown write disposition"):
        sink.load_file_to_table(spark, "nowhere.json", "raw", "t", "WRITE_MERGE")
    assert not (tmp_path / "x").exists()


def test_replace_append_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sink.load_path(spark.range(3), path)
    assert sink.load_path(spark.range(2), path, "WRITE_APPEND")
    assert spark.read.parquet(path).count() == 5
    assert not sink.load_path(spark.range(0), path, skip_if_empty=True)
    assert spark.read.parquet(path).count() == 5
    assert sink.load_path(spark.range(0), path)
    assert spark.read.parquet(path).count() == 0


def test_date_partitions_are_pruned(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    for day in (DAY, datetime.date(2026, 3, 27)):
        sink.load_path(sink.stamp(spark.range(5), day), path, "WRITE_APPEND", partition_by=["_ingestion_date"])
    assert sorted(p.name for p in Path(path).glob("_ingestion_date=*")) == [
        "_ingestion_date=2026-03-20",
        "_ingestion_date=2026-03-27",
    ]
    day = spark.read.parquet(path).filter(F.col("_ingestion_date") == F.lit(DAY))
    assert day.count() == 5
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan(day)


@pytest.fixture
def uncoalesced(spark):
    """Keep the small partitions that AQE would merge."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_clustering_spreads_a_hot_value(spark, uncoalesced):
    rows = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("key"), "id"
    )
    clustered = sink.cluster(rows, ["key"])
    assert clustered.columns == ["key", "id"]
    parts = clustered.select("key", F.spark_partition_id().alias("p"))
    assert clustered.count() == 40_000
    assert parts.filter("key = 7").select("p").distinct().count() > 1
    spans = parts.groupBy("p").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("p").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(spans, spans[1:]))


def test_rebalanced_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000, numPartitions=8).withColumn("day", F.expr("date_add(date'2026-01-01', int(id % 3))"))
    sink.load_path(rows, path, partition_by=["day"], rebalance=True)
    assert len(list(Path(path).glob("day=*/*.parquet"))) == 3
    assert spark.read.parquet(path).count() == 1000


def test_jsonl_export_keeps_nulls_and_accents(spark, tmp_path):
    df = spark.createDataFrame([("Ingénieur données", None)], "titre string, n bigint")
    path = sink.export_jsonl(df, str(tmp_path / "o.jsonl"))
    lines = [line for f in Path(path).glob("part-*") for line in f.read_text(encoding="utf-8").splitlines()]
    assert lines == ['{"titre":"Ingénieur données","n":null}']


def test_landing_path():
    assert sink.landing_path("s3a://bucket/", "geo", DAY, "regions.json") == "s3a://bucket/geo/2026-03-20/regions.json"


def test_file_to_table(spark, tmp_path):
    path = write_lines(tmp_path / "r.json", {"code": "2A", "nom": "Corse", "zone": "metro", "_score": 1})
    location = str(tmp_path / "table")
    sink.load_file_to_table(spark, path, "raw_t1", "geo", schema=schemas.GEO_REGIONS, location=location)
    sink.load_file_to_table(spark, path, "raw_t1", "geo", "WRITE_APPEND", schema=schemas.GEO_REGIONS)
    table = spark.table("raw_t1.geo")
    assert table.columns == ["nom", "code", "zone", "_ingestion_date"]
    assert [tuple(r) for r in table.collect()] == [("Corse", "2A", "metro", None)] * 2


def test_snapshot_age(spark):
    df = spark.createDataFrame([(datetime.date(2026, 2, 1),), (datetime.date(2026, 2, 18),)], "d date")
    assert tuple(freshness.snapshot_age(df, "d", DAY).first()) == (datetime.date(2026, 2, 18), 30, False)
    assert freshness.snapshot_age(df, "d", datetime.date(2026, 3, 19)).first()["skip"]
    assert tuple(freshness.snapshot_age(df.limit(0), "d", DAY).first()) == (None, None, False)


def test_file_freshness(spark, tmp_path, monkeypatch):
    folder = tmp_path / "sirene" / "2026-03-01"
    file = write_lines(folder / "stock.parquet", "x")
    now = datetime.datetime(2026, 3, 20, 12, tzinfo=datetime.UTC)
    root = str(tmp_path / "sirene")

    def age(days: float) -> None:
        moment = now.timestamp() - days * 86400
        os.utime(file, (moment, moment))

    age(29.9)
    assert freshness.file_age_days(spark, root, now) == 29
    assert freshness.should_skip(spark, root, now)
    age(30)
    assert not freshness.should_skip(spark, root, now)
    assert freshness.file_age_days(spark, str(tmp_path / "absent"), now) is None
    assert not freshness.should_skip(spark, str(tmp_path / "absent"), now)

    def broken(*_):
        raise RuntimeError("listing failed")

    monkeypatch.setattr(freshness, "file_age_days", broken)
    assert not freshness.should_skip(spark, root, now)


ADZUNA_FULL = {
    "id": "o-7001",
    "title": "Ingénieur données",
    "company": {"display_name": "Tram et fils", "__CLASS__": "C"},
    "location": {"display_name": "Rennes", "area": ["France", "Bretagne", "Ille-et-Vilaine"]},
    "salary_min": 41200,
    "salary_max": 47900,
    "salary_is_predicted": "0",
    "category": {"tag": "it-jobs", "label": "IT"},
    "created": "2026-02-11T16:05:42Z",
    "adref": "dropped",
}


def test_adzuna_mapping(spark, tmp_path):
    path = write_lines(
        tmp_path / "a.jsonl",
        ADZUNA_FULL,
        {"id": "o-7002", "title": "Analyste", "created": "2026-02-12T09:30:00Z"},
        {"id": 7, "company": "no object here", "location": {"area": None}},
    )
    df = landing.adzuna_rows(scan_json_text(spark, path, landing.ADZUNA_FIELDS))
    assert df.columns == schemas.ADZUNA.fieldNames()[:-1]
    rows = {r["offre_id"]: r.asDict() for r in df.collect()}
    full = rows["o-7001"]
    assert (full["entreprise_nom"], full["salaire_min"], full["salaire_est_estime"]) == ("Tram et fils", 41200.0, 0)
    assert full["localisation_area"] == ["France", "Bretagne", "Ille-et-Vilaine"]
    assert (full["categorie_tag"], full["categorie_libelle"]) == ("it-jobs", "IT")
    assert full["date_creation"] == datetime.datetime(2026, 2, 11, 16, 5, 42)
    given = {"offre_id", "titre", "date_creation"}
    assert all(v is None for k, v in rows["o-7002"].items() if k not in given)
    assert rows["7"]["entreprise_nom"] is None and rows["7"]["localisation_area"] is None


def test_one_parse_per_nested_field(spark, tmp_path):
    df = landing.adzuna_rows(scan_json_text(spark, write_lines(tmp_path / "a.jsonl", ADZUNA_FULL), landing.ADZUNA_FIELDS))
    optimised = df._jdf.queryExecution().optimizedPlan().toString()
    # The leaves of one field share the same expression, which is then evaluated once.
    parses = [part.split("Some(UTC)", 1)[0] for part in optimised.split("from_json(")[1:]]
    assert len(parses) == 5 and len(set(parses)) == 3


def test_load_adzuna_twice_appends(spark, tmp_path):
    path = write_lines(tmp_path / "a.jsonl", ADZUNA_FULL)
    where = str(tmp_path / "raw_adzuna")
    landing.load_adzuna(spark, path, DAY, "raw_t2.adzuna", location=where)
    landing.load_adzuna(spark, path, DAY, "raw_t2.adzuna", location=where)
    empty = write_lines(tmp_path / "empty.jsonl")
    landing.load_adzuna(spark, empty, DAY, "raw_t2.adzuna", location=where)
    table = spark.table("raw_t2.adzuna")
    assert table.drop("_row_hash").schema.simpleString() == schemas.ADZUNA.simpleString()
    assert table.count() == 2 and {r["_ingestion_date"] for r in table.collect()} == {DAY}


def test_load_france_travail(spark, tmp_path):
    offers = [
        {"id": "A", "intitule": "v1", "sequence": 1},
        {"id": "B", "intitule": "Y", "sequence": 2},
        {"id": "A", "intitule": "v2", "sequence": 3},
        *({"id": f"C{i}", "intitule": "many", "sequence": 10 + i} for i in range(1500)),
    ]
    path = write_lines(tmp_path / "ft.jsonl", *offers)
    landing.load_france_travail(spark, path, DAY, "raw_t3.ft", location=str(tmp_path / "ft"))
    table = spark.table("raw_t3.ft")
    assert table.drop("_row_hash").schema.simpleString() == schemas.FRANCE_TRAVAIL.simpleString()
    loaded = sorted((r["id"], r["intitule"]) for r in table.collect())
    assert loaded[:2] == [("A", "v2"), ("B", "Y")] and len(loaded) == 1502
def test_load_france_travail_in_line_order(spark, tmp_path):
    """Lines without a fetch order, as they are landed: the last line of an id wins, however the file is split."""
    lines = [{"id": f"o{i % 400}", "intitule": f"fetch {i}", "description": "x" * 40} for i in range(3000)]
    path = write_lines(tmp_path / "ft.jsonl", *lines)
    last = {line["id"]: line["intitule"] for line in lines}
    bytes_before, open_before = (spark.conf.get(f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes"))
    try:
        for n, size in enumerate(("1g", "7000", "911")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            landing.load_france_travail(spark, path, DAY, f"raw_t3.lines{n}", location=str(tmp_path / f"lines{n}"))
            assert {r["id"]: r["intitule"] for r in spark.table(f"raw_t3.lines{n}").collect()} == last
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_before)
        spark.conf.set("spark.sql.files.openCostInBytes", open_before)
    folder = tmp_path / "two"
    folder.mkdir()
    write_lines(folder / "a.jsonl", {"id": "A", "intitule": "a1"}, {"id": "B", "intitule": "b1"}, {"id": "B", "intitule": "b2"})
    write_lines(folder / "b.jsonl", {"id": "A", "intitule": "a2"}, {"id": "B", "intitule": "early", "sequence": None})
    landing.load_france_travail(spark, str(folder / "*.jsonl"), DAY, "raw_t3.two", location=str(tmp_path / "two_table"))
    assert sorted((r["id"], r["intitule"]) for r in spark.table("raw_t3.two").collect()) == [("A", "a2"), ("B", "early")]


def test_a_run_again_replaces_itself(spark, tmp_path):
    where = str(tmp_path / "raw_run")
    for rows, day in ((5, DAY), (3, datetime.date(2026, 3, 27)), (4, DAY)):
        assert sink.load_run(sink.stamp(spark.range(rows), day), "raw_t5.run", day, location=where) == rows
    assert sink.finished_runs(spark, "raw_t5.run") == {"2026-03-20": 4, "2026-03-27": 3}

    def per_day():
        return sorted((str(r[0]), r[1]) for r in spark.table("raw_t5.run").groupBy("_ingestion_date").count().collect())

    assert per_day() == [("2026-03-20", 4), ("2026-03-27", 3)]
    # Half-way through, a task fails: the date keeps its rows and is unfinished until it runs again.
    broken = sink.stamp(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("id")), DAY)
    with pytest.raises(PySparkException, match="lost"):
        sink.load_run(broken, "raw_t5.run", DAY)
    assert per_day() == [("2026-03-20", 4), ("2026-03-27", 3)] and list(sink.finished_runs(spark, "raw_t5.run")) == ["2026-03-27"]
    assert sink.load_run(sink.stamp(spark.range(6), DAY), "raw_t5.run", DAY) == 6 and per_day()[0][1] == 6
    # A run without rows leaves its date without rows; rows of other dates are not its own.
    assert sink.load_run(sink.stamp(spark.range(2), DAY), "raw_t5.run", datetime.date(2026, 3, 27)) == 0
    assert per_day() == [("2026-03-20", 6)] and sink.finished_runs(spark, "raw_t5.run") == {"2026-03-20": 6, "2026-03-27": 0}
    with pytest.raises(ValueError, match="partitioned by"):
        sink.load_run(spark.range(1), "raw_t5.run", DAY, partition_by=["id"])
    path = write_lines(tmp_path / "a.jsonl", ADZUNA_FULL)
    for _ in range(2):
        landing.load_adzuna(spark, path, DAY, "raw_t5.adzuna", location=str(tmp_path / "once"), once=True)
    assert spark.table("raw_t5.adzuna").count() == 1


@pytest.mark.parametrize("partition_by", [[], ["k"]])
@pytest.mark.parametrize("managed", [False, True])
def test_replace_is_one_step(spark, tmp_path, monkeypatch, partition_by, managed):
    """A reader sees the old rows or the new ones at every step; failures leave no folder behind."""
    layer = f"versions{len(partition_by)}{int(managed)}"
    table = f"{layer}.t"
    spark.sql(f"CREATE DATABASE {layer} LOCATION '{tmp_path}/db'")

    def rows(n):
        return spark.range(n).select("id", (F.col("id") % 2).alias("k"))

    where = f"{tmp_path}/db/t" if managed else str(tmp_path / "there")
    options = {"partition_by": partition_by} | ({} if managed else {"location": where})
    sink.load_table(rows(2), table, "WRITE_APPEND", **options)
    assert managed == (sink._details(spark, table)["Type"] == "MANAGED")
    begun = spark.table(table)
    seen, point = [], sink._point_table

    def watched(*args):
        seen.append(spark.table(table).count())
        point(*args)
        seen.append(spark.table(table).count())

    monkeypatch.setattr(sink, "_point_table", watched)
    sink.load_table(rows(3), table, **options)
    assert begun.count() == 2  # planned before, read after
    sink.load_table(rows(4), table, **options)
    sink.load_table(rows(5), table, **options)
    assert seen == [2, 3, 3, 4, 4, 5]
    assert len(list(Path(where).iterdir())) == 2  # the version read now and the one before
    sink.load_table(rows(1), table, "WRITE_APPEND", partition_by=partition_by)
    assert spark.table(table).count() == 6

    def stopped(*args):
        raise OSError("stopped between the steps")

    monkeypatch.setattr(sink, "_point_table", stopped)
    with pytest.raises(OSError, match="stopped"):
        sink.load_table(rows(9), table, **options)
    assert spark.table(table).count() == 6 and len(list(Path(where).iterdir())) == 2
    assert not sink.load_table(rows(0), table, skip_if_empty=True, **options) and spark.table(table).count() == 6
    monkeypatch.setattr(sink, "_point_table", point)
    sink.load_table(rows(3).withColumn("more", F.lit("x")), table, **options)
    assert spark.table(table).columns[-1] == (partition_by or ["more"])[-1] and spark.table(table).count() == 3
    spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_load_geo_urssaf_and_payroll(spark, tmp_path):
    paths = {
        "regions": write_lines(tmp_path / "r.json", {"code": "32", "nom": "Hauts-de-France", "zone": "metro"}),
        "departements": write_lines(tmp_path / "d.json", {"code": "59", "nom": "Nord", "codeRegion": "32", "zone": "metro"}),
        "communes": write_lines(
            tmp_path / "c.json",
            {"code": "59350", "nom": "Lille", "population": 236234, "surface": 3480,
             "centre": {"type": "Point", "coordinates": [3.06, 50.63]}},
        ),
    }
    landing.load_geo(spark, paths, DAY, "raw_t4")
    commune = spark.table("raw_t4.geo_communes").first()
    assert "surface" not in commune.asDict()
    assert commune["centre"]["coordinates"] == [3.06, 50.63] and commune["_ingestion_date"] == DAY

    wide = {"code_commune": "31555", "intitule_commune": "31555 Toulouse", "code_departement": "31", "code_ape": "6203Z"}
    lines = [
        {**wide, "effectifs_salaries_2022": 240, "nombre_d_etablissements_2022": 7},
        {**wide, "code_ape": "6201Z", "effectifs_salaries_2031": "12", "nombre_d_etablissements_2031": None, "effectifs_salaries_2030": None},
        {**wide, "code_ape": "7022Z", "effectifs_salaries_2022": 1, "nombre_d_etablissements_2022": 1},
    ]
    landing.load_urssaf_effectifs(spark, write_lines(tmp_path / "w.json", *lines), DAY, "raw_t4.effectifs")
    assert spark.table("raw_t4.effectifs").schema.simpleString() == schemas.URSSAF_EFFECTIFS.simpleString()
    assert sorted((r["annee"], r["effectifs_salaries"]) for r in spark.table("raw_t4.effectifs").collect()) == [(2022, 240), (2031, 12)]

    record = {
        "annee": "2023",
        "secteur_na88i": "62 Programmation, conseil et autres activités informatiques",
        "nombre_d_etablissements": 51300,
        "effectifs_salaries_moyens": 612400,
        "masse_salariale": 34100000000,
    }
    other = {**record, "secteur_na88i": "63 Services"}
    landing.load_urssaf_masse_salariale(spark, write_lines(tmp_path / "p.json", record, other), DAY, "raw_t4.payroll")
    assert [tuple(r) for r in spark.table("raw_t4.payroll").collect()] == [
        (62, "Programmation, conseil et autres activités informatiques", 2023, 51300, 612400, 34100000000, DAY)
    ]


def test_load_sirene_skips_recent(spark, tmp_path):
    stock = str(tmp_path / "landed" / "stock.parquet")
    spark.createDataFrame([("1", "A")], "siret string, etat string").write.parquet(stock)
    paths = {"sirene_etablissement": stock, "sirene_unite_legale": stock}
    now = datetime.datetime.now(datetime.UTC)
    assert not landing.load_sirene(spark, paths, str(tmp_path / "landed"), now, "raw_t5")
    later = now + datetime.timedelta(days=31)
    assert landing.load_sirene(spark, paths, str(tmp_path / "landed"), later, "raw_t5")
    assert spark.table("raw_t5.sirene_unite_legale").count() == 1


def test_scan_json_without_nested_rebuild(spark, tmp_path):
    schema = schemas.record(names=schemas.repeated(schemas.STRING))
    assert scan_json(spark, write_lines(tmp_path / "x.json", {"names": ["a", 1]}), schema).first()["names"] == ["a", "1"]


def test_a_failed_replace_leaves_the_old_rows(spark, tmp_path):
    good = spark.createDataFrame([("1",), ("2",)], "n string")
    bad = spark.createDataFrame([("3",), ("x",)], "n string")
    path = str(tmp_path / "numbers")
    for where in (None, str(tmp_path / "placed")):
        name = f"raw_t6.numbers_{'here' if where else 'own'}"
        sink.load_path(good, path)
        sink.load_table(good.select(F.col("n").cast("int")), name, location=where)
        for write in (lambda: sink.load_path(bad.select(F.col("n").cast("int")), path), lambda: sink.load_table(bad.select(F.col("n").cast("int")), name, location=where)):  # noqa: B023
            with pytest.raises(PySparkException):
                write()
        assert spark.read.parquet(path).count() == 2 and spark.table(name).count() == 2
        # Other columns, then the same again, then partitions.
        sink.load_table(good.select("n", F.lit(1).alias("k")), name, location=where)
        assert spark.table(name).columns == ["n", "k"]
        sink.load_table(good.limit(1).select("n", F.lit(1).alias("k")), name, location=where)
        assert spark.table(name).count() == 1
        sink.load_table(good.select("n", F.lit(1).alias("k")), name, partition_by=["k"], location=where)
        assert spark.table(name).filter("k = 1").count() == 2
        assert not sink.load_table(good.filter("n = '9'"), name, skip_if_empty=True, location=where) and spark.table(name).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["numbers", "placed"]


def test_survey_by_path(spark, tmp_path):
    cells = ["2025", "M1X80", "Métier", "C", "Famille", "11", "Région", "75", "Paris", "7501", "Bassin", "120", "*", ""]
    file = tmp_path / "survey.csv"
    file.write_text("extra," + ",".join(landing.BMO_HEADERS) + "\nx," + ",".join(cells) + "\n", encoding="utf-8")
    assert landing.load_bmo(spark, str(file), DAY, "raw_t7.bmo")
    row = spark.table("raw_t7.bmo").first()
    assert (row["annee"], row["projets_recrutement"], row["projets_difficiles"], row["projets_saisonniers"]) == (2025, 120, None, None)
    (tmp_path / "short.csv").write_text("annee,REG\n2025,11\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Missing columns"):
        landing.load_bmo(spark, str(tmp_path / "short.csv"), DAY, "raw_t7.bmo")

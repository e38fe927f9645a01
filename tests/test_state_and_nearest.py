"""The maintained state of the newest rows, and the nearest of many places."""

import datetime
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from emploiscope.operators.latest import latest_snapshot
from emploiscope.operators.nearest import LEAF, nearest_places, place_tree
from emploiscope.plans import current_state, intermediate
from emploiscope.sources import sink

SCHEMA = "offre_id string, note string, seq bigint, _ingestion_date date"


def state_rows(df):
    return sorted(tuple(r) for r in df.select("offre_id", "note", "seq", "_ingestion_date").collect())


def test_state_equals_full_dedup_after_random_batches(spark, tmp_path):
    random.seed(4)
    layer = f"state_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {layer} LOCATION '{tmp_path}/db'")
    raw, state, seq, read = f"{layer}.raw", f"{layer}.state", 0, []
    days = [datetime.date(2026, 3, d) for d in (20, 10, 25, 1, 20, 26, 10, 27, 25, 28)]  # late ones, and four loaded again
    for n, day in enumerate(days):
        rows = []
        for _ in range(random.randint(0 if n == 8 else 5, 0 if n == 8 else 40)):
            seq += 1
            rows.append((f"o{random.randint(0, 30)}", f"batch {n}", seq, day))
        batch = spark.createDataFrame(rows, SCHEMA)
        if n in (4, 8):  # what the date held before is gone
            sink.load_run(batch, raw, day)
        else:
            sink.load_table(batch, raw, "WRITE_APPEND", ["_ingestion_date"])
        read.append(current_state.absorb(spark, spark.table(raw), state, "offre_id", ["seq"]))
        assert state_rows(spark.table(state)) == state_rows(latest_snapshot(spark.table(raw), "offre_id", "_ingestion_date", ["seq"])), n
    assert read == [[str(d)] for d in days]
    assert current_state.absorb(spark, spark.table(raw), state, "offre_id", ["seq"]) == []


def test_only_new_dates_are_read(spark, tmp_path, plan):
    where = str(tmp_path / "raw")
    for d in (1, 2, 3):
        rows = spark.range(5).select(F.col("id").cast("string").alias("offre_id"), F.lit("x").alias("note"), "id")
        sink.load_path(sink.stamp(rows.withColumnRenamed("id", "seq"), datetime.date(2026, 1, d)), where, "WRITE_APPEND", ["_ingestion_date"])
    raw = spark.read.parquet(where)
    before = {d: f for d, f in current_state.partition_files(raw).items() if d != "2026-01-03"}
    new, replaced = current_state.changes(before, current_state.partition_files(raw))
    assert (new, replaced) == (["2026-01-03"], [])
    state = spark.createDataFrame([], SCHEMA)
    text = plan(current_state.advanced(state, raw, "offre_id", ["seq"], new, replaced))
    assert text.count("FileScan") == 1 and "2026-01-03" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert current_state.changes({"a": ["1", "2"]}, {"a": ["2", "3"]}) == (["a"], ["a"])
    assert current_state.changes({"a": ["1"], "b": ["1"]}, {"a": ["1", "2"]}) == (["a"], ["b"])


def brute(points, places):
    out = {}
    for lat, lon in points:
        if lat is None or lon is None or math.isnan(lat) or abs(lat) > 90 or abs(lon) > 180:
            continue
        narrow = math.cos(math.radians(lat))
        out[lat, lon] = min((((plon - lon) * narrow) ** 2 + (plat - lat) ** 2, key) for key, plat, plon in places if plat is not None and plon is not None)[1]
    return out


@pytest.mark.parametrize("spread_out", [0.5, 20.0, 170.0])
def test_nearest_against_all_pairs(spark, spread_out):
    random.seed(int(spread_out))
    places = [(f"p{k:03d}", random.uniform(-1, 1) * min(spread_out, 80), random.uniform(-1, 1) * spread_out) for k in range(60)]
    places += [("none", None, 1.0), ("p900", *places[0][1:])]  # equally near: the smaller key
    points = [(random.uniform(-90, 90), random.uniform(-180, 180)) for _ in range(80)] + [(random.gauss(0, 1), random.gauss(0, 1)) for _ in range(300)]
    points += [(0.0, 0.0), (0.25, 0.5), (90.0, 180.0), (-90.0, -180.0), (None, 1.0), (1.0, None), (91.0, 0.0), (float("nan"), 1.0), places[3][1:]]
    schema = "latitude double, longitude double, code string"
    df = spark.createDataFrame([(*p, "x") for p in points * 2], schema)
    found = nearest_places(df, spark.createDataFrame(places, "code string, latitude double, longitude double"), "code").collect()
    assert {(r["latitude"], r["longitude"]): r["code"] for r in found} == brute(points, places)
    assert len(found) == len({p for p in brute(points, places)})
    assert nearest_places(df, spark.createDataFrame([], "code string, latitude double, longitude double"), "code").count() == 0
    assert nearest_places(df.limit(0), spark.createDataFrame(places, "code string, latitude double, longitude double"), "code").count() == 0


def test_a_dense_region_is_divided_and_copies_count_once(spark):
    random.seed(8)
    places = [(f"p{k:04d}", random.gauss(48.85, 0.01), random.gauss(2.35, 0.01)) for k in range(600)]
    schema = "code string, latitude double, longitude double"
    copied = [(f"{code}{copy}", *place) for code, *place in places for copy in range(5)]
    points = [(random.gauss(48.85, 0.02), random.gauss(2.35, 0.02)) for _ in range(200)] + [(40.0 + k / 1000, 2.0) for k in range(20)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    found = {(r["latitude"], r["longitude"]): r["code"] for r in nearest_places(df, spark.createDataFrame(copied, schema), "code").collect()}
    assert found == brute(points, copied)
    known = spark.createDataFrame([(lat, lon, code) for code, lat, lon in places], "lat double, lon double, key string")
    nodes = [r for level in place_tree(known) for r in level.collect()]
    assert sorted(p["key"] for r in nodes for p in r["_places"] or ()) == [code for code, _, _ in places]
    assert max(len(r["_places"] or ()) for r in nodes) <= LEAF and max(len(r["_children"] or ()) for r in nodes) <= 16


def test_no_pair_of_every_point_and_place(spark, plan):
    offers = spark.createDataFrame([("a", 48.9, 2.3), ("b", None, None)], "offre_id string, latitude double, longitude double")
    communes = spark.createDataFrame([("75056", 48.86, 2.35), ("69123", 45.76, 4.83)], "code string, centre_lat double, centre_lon double")
    placed = intermediate.with_nearest_commune(offers, communes)
    assert "CartesianProduct" not in plan(placed) and "BroadcastNestedLoopJoin" not in plan(placed)
    assert sorted((r["offre_id"], r["code_commune"]) for r in placed.collect()) == [("a", "75056"), ("b", None)]

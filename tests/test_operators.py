import random
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emploiscope import schemas
from emploiscope.operators import grid, latest, lookup, quantile, reshape
from emploiscope.operators.quantile import median_profile
from emploiscope.plans import landing
from emploiscope.plans.declared_checks import APE_CODES, BMO_CODES, CHECKS


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_newest_snapshot_wins(spark):
    df = spark.createDataFrame(
        [("1", "2026-03-01", "old"), ("1", "2026-03-08", "new"), ("2", None, "only"), (None, "2026-03-01", "no id")],
        "id string, day string, v string",
    )
    assert rows(latest.latest_snapshot(df, "id", "day")) == sorted(
        [("1", "2026-03-08", "new"), ("2", None, "only"), (None, "2026-03-01", "no id")], key=repr
    )


def test_ties_do_not_depend_on_row_order(spark):
    data = [("1", "2026-03-08", v) for v in "abcdefgh"]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "id string, day string, v string").repartition(3)
        results.add(tuple(latest.latest_snapshot(df, "id", "day", ["v"]).first()))
    assert len(results) == 1


def test_last_wins(spark):
    df = spark.createDataFrame([("A", "v1", 1), ("B", "Y", 2), ("A", "v2", 3)], "id string, titre string, seq int")
    assert rows(latest.last_wins(df, "id", "seq")) == [("A", "v2", 3), ("B", "Y", 2)]
    assert latest.last_wins(df.limit(0), "id", "seq").count() == 0


def test_cap_is_exact_for_a_hot_group(spark):
    df = spark.range(20_000, numPartitions=16).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), "id"
    )
    got = latest.cap_per_group(df, ["g"], "id", 50, spread=4)
    assert got.columns == ["g", "id"]
    expected = {}
    for row in df.orderBy("id").collect():
        expected.setdefault(row["g"], []).append(row["id"])
    actual = {}
    for row in got.collect():
        actual.setdefault(row["g"], []).append(row["id"])
    assert {g: sorted(v) for g, v in actual.items()} == {g: v[:50] for g, v in expected.items()}


def test_rows_are_limited_before_the_shuffle(spark, plan):
    df = spark.range(20_000, numPartitions=4).select((F.col("id") % 3).alias("k"), "id")
    for limited in (latest.last_wins(df, "k", "id"), grid.cap_offers(df, "id", cell=["k"])):
        shuffles = plan(limited).split("Exchange hashpartitioning")[1:]
        assert shuffles and all("WindowGroupLimit" in below for below in shuffles)


def test_grid_has_every_cell(spark):
    cells = grid.request_grid(spark)
    assert cells.count() == cells.distinct().count() == 4 * 101
    assert len(grid.DEPARTEMENTS) == 101 and "2A" in grid.DEPARTEMENTS and "20" not in grid.DEPARTEMENTS
    assert "975" not in grid.DEPARTEMENTS and "976" in grid.DEPARTEMENTS


def test_grid_coverage_and_cap(spark):
    offers = spark.createDataFrame(
        [("M1805", "75", n) for n in range(5)] + [("M1805", "99", 0)], "rome string, departement string, seq int"
    )
    cover = grid.grid_coverage(grid.request_grid(spark, ["M1805"], ["75", "2A"]), offers, cap=5)
    assert rows(cover) == [("M1805", "2A", 0, False), ("M1805", "75", 5, True)]
    assert grid.cap_offers(offers, "seq", 3).filter("departement = '75'").count() == 3


def test_fetches_are_concatenated_by_name(spark):
    one = spark.createDataFrame([("A", 1)], "id string, n int")
    two = spark.createDataFrame([(2, "B")], "n int, id string")
    three = spark.createDataFrame([("C",)], "id string")
    assert rows(grid.concat_fetches([one, two, three])) == sorted([("A", 1), ("B", 2), ("C", None)], key=repr)


def test_rename_keeps_order_and_drops_others(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Code métier BMO` int, x int, annee int")
    assert reshape.rename(df, {"annee": "annee", "Code métier BMO": "code"}).columns == ["annee", "code"]


SURVEY = [
    ("2025", "M1X80", "75", "2824", "1158", "11"),
    ("2025", "M2X90", "69", "526", "371", "*"),
    ("2025", "V4Z82", "75", "450", "200", "100"),
    ("2025", "M2X93", "59", "180", "90", "20"),
]


def survey(spark, data=SURVEY):
    df = spark.createDataFrame(data, "annee string, `Code métier BMO` string, Dept string, met string, xmet string, smet string")
    for header in landing.BMO_HEADERS:
        if header not in df.columns:
            df = df.withColumn(header, F.lit("t"))
    return df


def test_bmo_rows(spark):
    got = landing.bmo_rows(survey(spark))
    expected = [f.simpleString() for f in schemas.BMO][:-1]
    assert [f.simpleString() for f in got.schema] == expected
    picked = got.select("code_metier_bmo", "code_departement", "projets_recrutement", "projets_saisonniers")
    assert rows(picked) == [("M1X80", "75", 2824, 11), ("M2X90", "69", 526, None), ("M2X93", "59", 180, 20)]


def test_bmo_rows_need_all_headers(spark):
    with pytest.raises(ValueError, match=r"Missing columns: \['smet'\]"):
        landing.bmo_rows(survey(spark).drop("smet"))


def test_bmo_numbers_must_be_numbers(spark):
    with pytest.raises(PySparkException):
        landing.bmo_rows(survey(spark, [("2025", "M1X80", "75", "n/a", "1", "1")])).collect()


def test_bmo_filter_reaches_parquet(spark, tmp_path, plan):
    path = str(tmp_path / "survey.parquet")
    survey(spark).write.parquet(path)
    text = plan(landing.bmo_rows(spark.read.parquet(path)).select("projets_recrutement"))
    assert "PushedFilters: [In(`Code métier BMO`" in text or "In(Code métier BMO" in text
    assert "NomDept" not in text.split("ReadSchema")[1]


WIDE = "code_commune string, intitule_commune string, code_departement string, code_ape string, "


def test_unpivot_keeps_years_with_any_measure(spark, plan):
    df = spark.createDataFrame(
        [("31555", "31555 Toulouse", "31", "6203Z", 240, 7, 251, 8, None, None), ("75101", "x", "75", "6201Z", 5, None, None, 4, None, None)],
        WIDE + "effectifs_salaries_2022 int, nombre_d_etablissements_2022 int, effectifs_salaries_2023 int, "
        "nombre_d_etablissements_2023 int, effectifs_salaries_2024 int, nombre_d_etablissements_2024 int",
    )
    got = landing.urssaf_effectifs_rows(df)
    assert rows(got.select("code_commune", "annee", "effectifs_salaries", "nb_etablissements")) == sorted(
        [("31555", 2022, 240, 7), ("31555", 2023, 251, 8), ("75101", 2022, 5, None), ("75101", 2023, None, 4)], key=repr
    )
    assert "Exchange" not in plan(got)


def test_unpivot_years_come_from_the_first_family(spark):
    df = spark.createDataFrame(
        [("1", "1 x", "01", "6201Z", 7, 1, 9, 3)],
        WIDE + "effectifs_salaries_2020 int, nombre_d_etablissements_2021 int, effectifs_salaries_20200 int, effectifs_salaries_moyens int",
    )
    got = landing.urssaf_effectifs_rows(df).select("annee", "effectifs_salaries", "nb_etablissements")
    assert rows(got) == [(2020, 7, None)]
    with pytest.raises(ValueError, match="No column named effectifs_salaries_YYYY"):
        landing.urssaf_effectifs_rows(df.drop("effectifs_salaries_2020"))


def test_payroll_is_filtered_split_and_in_year_order(spark):
    data = [("2023", "62 A b", 1, 2, 3), ("2021", "62 A b", 4, 5, 6), ("2022", "63 C", 7, 8, 9)]
    df = spark.createDataFrame(
        data,
        "annee string, secteur_na88i string, nombre_d_etablissements int, effectifs_salaries_moyens int, masse_salariale int",
    )
    got = landing.urssaf_masse_salariale_rows(df)
    assert [tuple(r) for r in got.collect()] == [(62, "A b", 2021, 4, 5, 6), (62, "A b", 2023, 1, 2, 3)]
    assert [f.simpleString() for f in got.schema] == [f.simpleString() for f in schemas.URSSAF_MASSE_SALARIALE][:-1]


def test_project_paths(spark):
    df = spark.createDataFrame(
        [('{"b":{"c":"1","d":[1,2]},"e":null}', "plain"), ('"text"', None), (None, "[1]"), ('{"b":"flat"}', "x")],
        "a string, top string",
    ).coalesce(1)
    types = {"d": schemas.repeated(schemas.STRING), "c": schemas.LONG, "top": schemas.STRING}
    got = reshape.project_paths(df, {"a.b.c": "c", "a.b.d": "d", "a.b.c.x": "x", "a.e": "e", "top": "top"}, types)
    assert [tuple(r) for r in got.collect()] == [
        (1, ["1", "2"], None, None, "plain"),
        (None, None, None, None, None),
        (None, None, None, None, "[1]"),
        (None, None, None, None, "x"),
    ]


def test_lookup_with_repeated_keys_does_not_multiply(spark):
    reference = spark.createDataFrame([("b", "2"), ("a", "1"), ("a", "0")], "nom string, code string")
    unique = lookup.unique_lookup(reference, F.col("nom"), ["code", "nom"])
    df = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    named = lookup.add_names(df, unique, F.col("k"), "_key", {"code": "code"})
    assert rows(named) == sorted([("a", "0"), ("c", None), (None, None)], key=repr)


def test_small_references_are_broadcast_and_large_ones_not(spark, plan):
    df = spark.range(1000).withColumn("k", F.col("id").cast("string"))
    reference = spark.range(10).select(F.col("id").cast("string").alias("code"), F.lit("n").alias("nom"))
    joined = lookup.add_names(df, reference, F.col("k"), "code", {"nom": "nom"})
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        joined = lookup.add_names(df, reference, F.col("k"), "code", {"nom": "nom"})
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", range(3))
def test_median_profile_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    groups = {"hot": 900, "one": 1, "two": 2, "even": 50, None: 31}
    data = []
    for key, size in groups.items():
        for _ in range(size):
            value = rng.choice([rng.uniform(-1e6, 1e6), rng.randint(-3, 3) * 0.5, rng.lognormvariate(10, 0.2), None])
            data.append((key, value))
    data += [("all null", None)] * 4 + [("same", 12000.0)] * 200
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = {r["k"]: tuple(r)[1:] for r in median_profile(df, ["k"], "v").collect()}
    expected = {}
    for key in {k for k, _ in data}:
        values = [v for k, v in data if k == key and v is not None]
        size = sum(k == key for k, _ in data)
        expected[key] = (size, len(values), statistics.median(values) if values else None)
    assert set(got) == set(expected)
    for key, (size, valued, median) in expected.items():
        assert got[key][:2] == (size, valued), key
        assert got[key][2] == (median if median is None else pytest.approx(median, rel=1e-15, abs=0)), key


def test_median_profile_with_weights(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("a", 9.0, 2), ("a", None, 4), ("b", 2.0, 1), ("b", 4.0, 1)], "k string, v double, n int")
    assert rows(median_profile(df, ["k"], "v", weight="n")) == [("a", 11, 7, 1.0), ("b", 2, 2, 3.0)]


def test_median_profile_of_several_keys_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 7.0), ("a", 2, 1.0)], "k string, y int, v double")
    assert rows(median_profile(df, ["k", "y"], "v")) == [("a", 1, 2, 2, 6.0), ("a", 2, 1, 1, 1.0)]
    assert median_profile(df.limit(0), ["k"], "v").count() == 0


def test_median_profile_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "v.parquet")
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v")).write.parquet(path)
    df = median_profile(spark.read.parquet(path), ["k"], "v")
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_median_of_close_values_and_of_nan(spark):
    nan, inf = float("nan"), float("inf")
    data = [("nan", v) for v in (nan, 1.0, 2.0)] + [("inf", v) for v in (inf, -inf, 5.0, None)] + [("far", v) for v in (1e300, -1e300, 1e-300, 0.0, 7.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r["median"] for r in median_profile(df, ["k"], "v").collect()}
    assert got == {"nan": 2.0, "inf": 5.0, "far": 1e-300}
    # A hundred thousand values within 0.01: no bucket holds more than a few of them.
    close = spark.range(100_000).select(F.lit("a").alias("k"), (F.col("id") / 1e7).alias("v"))
    assert median_profile(close, ["k"], "v").first()["median"] == pytest.approx(49999.5 / 1e7)
    sizes = close.groupBy(quantile._bucket(F.col("v"), F.lit(0.0), F.lit(0.0099999))).count().agg(F.max("count")).first()[0]
    assert sizes < 10


def test_fixed_lists_are_pinned():
    """The SQL twins read these lists from the product, so they stand here on their own."""
    assert APE_CODES == ["6201Z", "6202A", "6203Z", "6209Z"]
    assert BMO_CODES == ["M1X80", "M1X81", "M2X90", "M2X91", "M2X92", "M2X93"]
    assert grid.ROME_CODES == ["M1805", "M1810", "M1806", "M1801"]
    assert grid.DEPARTEMENTS[17:23] == ["18", "19", "2A", "2B", "21", "22"] and grid.DEPARTEMENTS[-6:] == ["95", "971", "972", "973", "974", "976"]
    assert len(grid.DEPARTEMENTS) == len(set(grid.DEPARTEMENTS)) == 101 and grid.MAX_OFFERS == 1150
    assert {model: len(checks) for model, checks in CHECKS.items()} == {'stg_adzuna__offres': 12, 'stg_geo__regions': 5, 'stg_geo__departements': 8, 'stg_geo__communes': 9, 'stg_bmo__projets_recrutement': 7, 'stg_urssaf__effectifs_commune_ape': 8, 'stg_sirene__etablissements': 11}

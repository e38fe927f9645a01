import pytest

from emploiscope.operators import quality as q
from emploiscope.plans.declared_checks import CHECKS, check_model


def report(df, *checks, parents=None):
    return [tuple(r) for r in q.run_checks(df, "m", checks, parents).collect()]


@pytest.fixture(scope="module")
def people(spark):
    data = [("1", "a", True, 1), ("1", "b", None, 1), (None, "x", False, 2), (None, "x", False, 2), ("2", None, True, None)]
    return spark.createDataFrame(data, "id string, kind string, flag boolean, n int")


def test_not_null(people):
    assert report(people, q.not_null("id"), q.not_null("kind"), q.not_null("flag")) == [
        ("m", "id", "not_null", "error", 2),
        ("m", "kind", "not_null", "error", 1),
        ("m", "flag", "not_null", "error", 1),
    ]


def test_unique_ignores_nulls(people):
    assert report(people, q.unique("id"), q.unique("n")) == [
        ("m", "id", "unique", "error", 1),
        ("m", "n", "unique", "error", 2),
    ]


def test_accepted_values_count_distinct_wrong_ones(people):
    checks = [
        q.accepted_values("kind", ["a"]),
        q.accepted_values("kind", ["a", "b", "x"]),
        q.accepted_values("flag", [True]),
        q.accepted_values("flag", [True, False]),
    ]
    assert [r[4] for r in report(people, *checks)] == [2, 0, 1, 0]


def test_relationships_count_child_rows(spark, people):
    parents = {"kinds": spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "code string")}
    check = q.relationships("kind", "kinds", "code")
    assert report(people, check, parents=parents) == [("m", "kind", "relationships", "error", 2)]


def test_unique_combination(people):
    assert report(people, q.unique_combination("id", "kind"))[0] == (
        "m", "id, kind", "unique_combination_of_columns", "error", 1
    )


def test_where_and_severity(people):
    checks = [
        q.not_null("id", where="n = 2", severity=q.WARN),
        q.unique("id", where="kind = 'a'"),
        q.accepted_values("kind", ["a"], where="flag"),
    ]
    assert sorted(r[2:] for r in report(people, *checks)) == [
        ("accepted_values", "error", 0),
        ("not_null", "warn", 2),
        ("unique", "error", 0),
    ]


def test_not_null_under_its_own_not_in_never_fails(people):
    assert report(people, q.not_null("id", where="id NOT IN ('9')"))[0][4] == 0


def test_no_rows_still_give_a_report(people):
    checks = [q.not_null("id"), q.accepted_values("kind", ["a"]), q.unique("id"), q.unique_combination("id", "kind")]
    assert [r[4] for r in report(people.limit(0), *checks)] == [0, 0, 0, 0]


def test_enforce(people):
    q.enforce(q.run_checks(people, "m", [q.not_null("id", severity=q.WARN), q.not_null("kind", where="n = 2")]))
    with pytest.raises(q.CheckFailed, match="m.id not_null: 2"):
        q.enforce(q.run_checks(people, "m", [q.not_null("id"), q.not_null("flag", where="n = 2")]))


def test_row_checks_share_one_scan(people):
    checks = [q.not_null("id"), q.accepted_values("kind", ["a"]), q.accepted_values("flag", [True]), q.not_null("n")]
    optimised = q.run_checks(people, "m", checks)._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("LogicalRDD") == 1


def test_declared_checks_on_a_bad_table(spark):
    regions = spark.createDataFrame([("11", "IDF", "metro"), ("11", None, "sea")], "code string, nom string, zone_geo string")
    failures = {(r["column"], r["test"]): r["failures"] for r in check_model(regions, "stg_geo__regions").collect()}
    assert failures == {
        ("code", "unique"): 1,
        ("code", "not_null"): 0,
        ("nom", "not_null"): 1,
        ("zone_geo", "not_null"): 0,
        ("zone_geo", "accepted_values"): 1,
    }


def test_declared_checks_cover_every_staged_table_with_checks():
    assert {name: len(checks) for name, checks in CHECKS.items()} == {
        "stg_adzuna__offres": 12,
        "stg_geo__regions": 5,
        "stg_geo__departements": 8,
        "stg_geo__communes": 9,
        "stg_bmo__projets_recrutement": 7,
        "stg_urssaf__effectifs_commune_ape": 8,
        "stg_sirene__etablissements": 11,
    }

import os

import pytest

import __spark_entry__ as entry
from crosscheck.compare import connect, differences
from crosscheck.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("CROSSCHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == ""


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["categorie_metier", "n_offres", "n_avec_salaire", "salaire_annuel_median"]
    assert df.count() == 7


def test_no_python_worker_and_no_cartesian_product(spark, plan):
    for name, query in QUERIES.items():
        text = plan(query(spark, SF_DIR))
        for operator in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, (name, operator)

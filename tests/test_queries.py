import os

import pytest

import __spark_entry__ as entry_module
from catalog.queries import QUERIES as CATALOG
from oracle import connect, spark_table, sql_table

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def sf_dir(data):
    return os.path.dirname(data("0.001", "orders"))


@pytest.fixture(scope="module")
def engine(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert [r["cluster"] for r in rows] == [0, 1, 2, 3] and sum(r["n"] for r in rows) == 6000


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(CATALOG) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, engine, name):
    columns, rows = spark_table(QUERIES[name](spark, sf_dir))
    expected_columns, expected = sql_table(engine, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_lineitem_fit_is_settled_and_no_worse_than_three_plain_steps(spark, sf_dir):
    fitted = QUERIES["kmeans_on_lineitem"](spark, sf_dir).collect()
    plain = QUERIES["lloyd_steps"](spark, sf_dir).collect()
    assert len(fitted) == 4 and fitted[0]["inertia"] <= plain[0]["inertia"]


def test_training_metrics(spark, sf_dir):
    values = {r["key"]: r["value"] for r in QUERIES["training"](spark, sf_dir).collect()}
    assert values["silhouette_score"] > 0.35
    assert values["eval_inertia"] == values["inertia"] == pytest.approx(values["eval_inertia_on_data"])


def test_separated_blobs_pass_the_gate(spark, sf_dir):
    values = {r["key"]: r["value"] for r in QUERIES["evaluation_of_blobs"](spark, sf_dir).collect()}
    assert values["promoted"] == 1.0 and values["eval_silhouette_score"] > 0.35

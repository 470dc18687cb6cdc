"""Every registered query against its SQL, or for content where there is none."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_forest_queries(spark, sf_dir, duck):
    """No SQL can grow the same trees; the number of rows and of flags is known."""
    results = QUERIES["anomaly_scores"](spark, sf_dir)
    clean = duck.execute(f"select count(*) from ({SQL['clean_punches']})").fetchall()[0][0]
    flagged = results.where("predicted_anomaly").count()
    assert results.count() == clean
    assert 0 < flagged <= clean - int(0.97 * (clean - 1))
    assert results.where("predicted_anomaly <> (anomaly_score > 0)").count() == 0
    hints = duck.execute(f"select reason_hint, count(*) from ({SQL['reason_hint']}) group by all").fetchall()
    assert {r.reason_hint: r["count"] for r in results.groupBy("reason_hint").count().collect()} == dict(hints)

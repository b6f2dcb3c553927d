"""Every registered query against its SQL statement on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, difference

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


# The training-data queries have tests of their own.
OWN = {q for q in ORACLES if q == "pipeline" or q.startswith("op") and q[2:3].isdigit()}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - OWN))
def test_matches_sql(spark, con, small, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) == ""


def test_every_query_has_a_statement():
    own = {q for q in QUERIES if q == "pipeline" or q.startswith("op") and q[2:3].isdigit()}
    assert set(QUERIES) - own == set(ORACLES) - OWN


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 6 and all(0 <= r["taxa"] <= 1 for r in rows)


def test_fixture_has_one_parent_per_key(con):
    keys = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ]
    for child, fk, parent, pk in keys:
        sql = f"""SELECT count(*) FROM {child} LEFT JOIN
            (SELECT {pk} AS pk, count(*) AS n FROM {parent} GROUP BY 1) ON {fk} = pk
            WHERE n IS DISTINCT FROM 1"""
        assert con.execute(sql).fetchall() == [(0,)]


def test_known_values(spark):
    """Figures published with the fixture for the middle scale."""
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["average_precision"](spark, folder).filter("modelo = 'valor'").collect()
    assert rows[0]["pr_auc_w"] == round(0.0011369042361098877, 9)
    assert QUERIES["time_cutoff"](spark, folder).first()["corte"] == 961248547
    assert QUERIES["duplicate_ids"](spark, folder).first()["ids_duplicados"] == 11785

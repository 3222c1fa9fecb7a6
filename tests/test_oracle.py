"""Every registered query against its DuckDB oracle on the small tables."""

import pytest

from docketflow.plans.oracle import ORACLE
from docketflow.plans.registry import QUERIES
from oracle_compare import compare, duck

NAMES = sorted(n for n in QUERIES if n in ORACLE)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], sf_dir, con)
    assert r["cols_equal"], (r["spark_cols"], r["duck_cols"])
    assert r["values_equal"], r["diff"]


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLE[name]).fetchall()}
    assert spark_types == duck_types

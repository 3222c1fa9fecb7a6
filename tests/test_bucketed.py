"""Records bucketed by case key need no shuffle; keys seen once are dropped by
case."""

from contextlib import contextmanager

import pytest

from docketflow.operators.cases import KEY
from docketflow.operators.decisions import latest_decision
from docketflow.operators.durations import case_durations, case_gaps
from docketflow.operators.header import header_table, header_values, rare_by_case
from docketflow.operators.parties import party_table
from docketflow.plans.tidy import litigation_summary, tidy_cases
from docketflow.plans.tidy_fast import tidy_cases_fast
from docketflow.sources.inputs import CASES_SCHEMA, write_cases_by_key


@contextmanager
def as_at_scale(spark):
    """No table is small enough to be broadcast; the plan as it is written."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(tuple(map(repr, r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def bucketed(spark, cases, tmp_path_factory):
    return write_cases_by_key(cases, f"{tmp_path_factory.mktemp('bucketed')}/cases", 8)


def test_rows_are_equal(cases, bucketed):
    for job in (tidy_cases, tidy_cases_fast, header_table, header_values, party_table, case_gaps, case_durations, latest_decision, litigation_summary):
        assert _rows(job(bucketed)) == _rows(job(cases)), job.__name__


def test_no_shuffle_of_records(spark, bucketed, cases):
    with as_at_scale(spark):
        for job, small in ((party_table, 0), (case_durations, 0), (latest_decision, 0), (header_table, 1), (tidy_cases, 1), (tidy_cases_fast, 1)):
            plan = _plan(job(bucketed))
            # the one exchange moves the table of cases with keys seen once
            assert plan.count("Exchange") == small, job.__name__
            assert _plan(job(cases)).count("Exchange hashpartitioning") > small


def test_reads_stay_pruned(bucketed):
    plan = _plan(case_durations(bucketed))
    scan = plan[plan.index("ReadSchema"):]
    assert "movement" in scan and "title" not in scan and "decisions" not in scan and KEY in scan


def test_header_rows_are_not_dealt_by_key_name(spark, cases):
    with as_at_scale(spark):
        plan = _plan(header_table(cases))
        assert "hashpartitioning(data" not in plan and plan.count("SortMergeJoin") == 1
        # both sides of the join and the grouping share the case key
        assert plan.count("Exchange hashpartitioning(case_key") == plan.count("Exchange") == 2


def test_keys_seen_once(spark):
    def case(id1, file, *data):
        return (file, "result", (id1, list(data), [], [], []))
    rows = [case("1", "f", ("Relator", "a"), ("So aqui", "b"), (None, "c"), ("RELATOR ", "d")), case(None, None, ("Relatór", "e"), ("Outra", "f")),
            case("2", "g", ("só  aqui 2", "x"), ("So aqui 2", "y")), case("3", None), ("h", "error", ("4", [("Erro", "z")], [], [], []))]
    df = spark.createDataFrame(rows, CASES_SCHEMA)
    got = {(r[KEY].n_processo, r[KEY].file): (r.n_rare, {x.data for x in r.rare}) for r in rare_by_case(df).collect()}
    assert got == {("1", "f"): (2, {"so aqui", None}), (None, None): (1, {"outra"})}
    kept = {(r.n_processo, r.data, r.value) for r in header_values(df).collect()}
    assert kept == {("1", "relator", "a@d"), (None, "relator", "e"), ("2", "so aqui 2", "x@y")}

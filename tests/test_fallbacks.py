"""One result for one input: NULL keys, many spellings, repeated cases, rows
of a case in several files, copied folders."""

import datetime as dt

import pytest

from docketflow.operators.companies import company_label, label_distinct
from docketflow.operators.decisions import latest_decision
from docketflow.operators.header import header_values, header_wide
from docketflow.operators.parties import party_sides
from docketflow.plans.tidy import litigation_summary, tidy_cases
from docketflow.plans.tidy_fast import tidy_cases_fast
from docketflow.sources.inputs import CASES_SCHEMA, read_cases
from pyspark.sql import functions as F

DAY = dt.date(2020, 1, 1)


def _rows(df):
    return sorted(tuple(map(repr, r)) for r in df.select(*sorted(df.columns)).collect())


def case(id1, file, data=(("Relator", "X"),), name="A", decision="Negaram provimento"):
    return (file, "result", (id1, list(data), [(name, "Apelante", "Apelante")], [(DAY, "t", None)], [(DAY, decision)]))


NULL_KEYS = [case("1", "f1"), case(None, "f2"), case("3", None), case(None, None)]
MANY = [case("9", "f9", [(f"chave {i}", "v") for i in range(300)] + [("Relator", "Z")])]
TWICE = [case("1", "f1", [("Relator", "Y"), ("Chave", "w")], "B", "Deram provimento"), case(None, "f2", name="C")]


@pytest.mark.parametrize("rows", [NULL_KEYS, NULL_KEYS + MANY, NULL_KEYS + TWICE, NULL_KEYS + MANY + TWICE])
def test_null_keys_stay_whatever_else_is_there(spark, tmp_path, rows):
    spark.createDataFrame(rows, CASES_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/c")
    c = read_cases(spark, f"{tmp_path}/c")
    got = _rows(tidy_cases(c))
    assert got == _rows(tidy_cases_fast(c))
    keys = {(r.n_processo, r.file) for r in tidy_cases(c).collect()}
    assert keys == {(r[2][0], r[0]) for r in rows}
    assert litigation_summary(c).agg(F.sum("n_cases")).first()[0] == len(keys)


def test_more_spellings_change_nothing_else(spark):
    few = spark.createDataFrame(NULL_KEYS, CASES_SCHEMA)
    many = spark.createDataFrame(NULL_KEYS + MANY, CASES_SCHEMA)
    old = {r for r in _rows(header_wide(few))}
    assert old <= {r for r in _rows(header_wide(many))}


def test_a_case_of_single_keys_only_has_no_header(spark):
    rows = [*NULL_KEYS, case("5", "f5", [("So uma vez", "v")])]
    c = spark.createDataFrame(rows, CASES_SCHEMA)
    assert "5" not in {r.n_processo for r in tidy_cases(c).collect()}
    assert _rows(tidy_cases(c)) == _rows(tidy_cases_fast(c))


def test_copied_folders_give_equal_answers(spark, tmp_path):
    first, second = case("1", "f"), case("1", "f", [("Relator", "Y"), ("Relator", "X")], "B", "Deram provimento")
    for folder in ("p", "q/deep", "zz", "a"):
        for i, row in enumerate((first, second)):
            spark.createDataFrame([row], CASES_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/{folder}/sg_date=2020-01-0{i + 1}")
        c = read_cases(spark, f"{tmp_path}/{folder}")
        assert [r.value for r in header_values(c).collect()] == ["X@Y"]
        assert party_sides(c).collect()[0].ativo == "A\nB"
        assert latest_decision(c).collect()[0].decision == "Negaram provimento"
        assert _rows(tidy_cases(c)) == _rows(tidy_cases_fast(c))


def test_labels_of_missing_names(spark):
    df = spark.createDataFrame([(1, "Banco Itau"), (2, None), (3, None), (4, "Banco Itau")], "i int, n string")
    got = label_distinct(df, "n", lambda d: d.select("n", company_label(F.col("n")).alias("c")))
    assert sorted((r.i, r.c is None) for r in got.collect()) == [(1, False), (2, True), (3, True), (4, False)]
    assert got.columns == ["n", "i", "c"] or set(got.columns) == {"i", "n", "c"}

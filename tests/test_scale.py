"""Input building and branches whose shuffles and tasks stay small as tables grow."""

import datetime as dt
import os
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from docketflow.operators import cases as C
from docketflow.operators import header as H
from docketflow.operators import movements as MV
from docketflow.operators.cases import KEY
from docketflow.operators.decisions import latest_decision
from docketflow.operators.durations import case_durations, case_gaps
from docketflow.operators.header import header_table, keys_once
from docketflow.operators.movements import movement_rows
from docketflow.operators.parties import party_table
from docketflow.plans import registry as R
from docketflow.plans.tidy import tidy_cases
from docketflow.session import stored
from docketflow.sources import fixtures as X
from docketflow.sources import store
from docketflow.sources.inputs import CASES_SCHEMA
from docketflow.sources.pages import build_docket_pages
from docketflow.streaming.daily_ingest import LOG_SCHEMA, newest_fetch


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_build_deals_bare_columns_once(spark, sf_dir):
    for build in (X.build_cases, build_docket_pages):
        plan = _plan(build(X.Fixtures(spark, sf_dir)))
        assert plan.count("Exchange") == 1 and "Window" not in plan and "Join" not in plan, build.__name__


def test_build_tasks_grow_with_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(X, "ROWS_PER_TASK", 500)
    for in_order in (True, False):
        assert X.by_order(X.Fixtures(spark, sf_dir), in_order).rdd.getNumPartitions() > 8
    assert X.build_cases(X.Fixtures(spark, sf_dir)).count() > 1000


@pytest.mark.parametrize("job", [party_table, latest_decision, case_durations])
def test_records_are_dealt_not_their_rows(cases, job):
    plan = _plan(job(cases))
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Aggregate") < plan.index("Exchange") and "Aggregate" not in plan[plan.index("Exchange"):]


@pytest.mark.parametrize("job", [party_table, latest_decision, header_table, case_durations, case_gaps])
def test_branch_tasks_grow_with_records(cases, job, monkeypatch):
    monkeypatch.setattr(C, "ROWS_PER_TASK", 50)
    n = -(-cases.count() // 50)
    assert n > 8 and f", {n})" in _plan(job(cases))


def test_all_branches_of_the_tidy_table_have_as_many_tasks(cases, monkeypatch):
    # else one is dealt a second time to meet the others, out of few tasks
    monkeypatch.setattr(C, "ROWS_PER_TASK", 50)
    plan = _plan(tidy_cases(cases))
    n = -(-cases.count() // 50)
    dealt = re.findall(r"Exchange hashpartitioning\(case_key[^,]*, (\d+)\)", plan)
    assert len(dealt) >= 4 and set(dealt) == {str(n)} and "Window" not in plan


def test_buckets_grow_with_records(spark, sf_dir, cases, monkeypatch):
    monkeypatch.setattr(C, "ROWS_PER_TASK", 50)
    taken = []
    monkeypatch.setattr(R, "write_cases_by_key", lambda cases, path, buckets: taken.append(buckets) or cases)
    R.bucketed_tidy(spark, sf_dir)
    assert taken == [-(-cases.count() // 50)] and taken[0] > 8


def test_gaps_of_a_case_of_many_records(spark):
    def mov(*days):
        return [(d and dt.date(*d), "t", "x") for d in days]
    rows = [("f", "result", ("1", [], [], mov((2010, 1, 5), None, (1999, 1, 1), (2010, 1, 1)), [])), ("f", "result", ("1", [], [], mov((2010, 1, 3), (2010, 1, 5)), [])),
            ("g", "result", ("2", [], [], mov((2000, 1, 1), None), [])), ("h", "error", ("3", [], [], mov((2010, 1, 1)), [])),
            ("i", "result", ("4", [], [], None, [])), (None, "result", (None, [], [], mov((2001, 1, 1)), []))]
    df = spark.createDataFrame(rows, CASES_SCHEMA)
    first = (dt.date(2010, 1, 1) - dt.date(1970, 1, 1)).days
    got = sorted(((r.n_processo or "", r.movement, r.gap_days) for r in case_gaps(df).collect()))
    assert got == [("", dt.date(2001, 1, 1), first - 9 * 365 - 2), ("1", dt.date(2010, 1, 1), first), ("1", dt.date(2010, 1, 3), 2),
                   ("1", dt.date(2010, 1, 5), 0), ("1", dt.date(2010, 1, 5), 2)]
    assert {(r.n_processo, r.time_tot, r.time_clean) for r in case_durations(df).collect()} == {("1", 4.0, 4.0), (None, 0.0, 0.0)}


def test_header_rows_are_counted_unsorted(cases):
    plan = _plan(keys_once(cases))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan


def test_cases_of_one_hash_keep_their_own_rare_keys(spark, monkeypatch):
    rows = [("f", "result", ("1", [("Relator", "a"), ("So aqui", "b")], [], [], [])), ("g", "result", ("2", [("Relator", "c")], [], [], [])),
            ("h", "result", ("3", [(None, "d"), ("Outra", "e")], [], [], []))]
    df = spark.createDataFrame(rows, CASES_SCHEMA)
    monkeypatch.setattr(H.F, "xxhash64", lambda *c: H.F.lit(7).cast("bigint"))
    got = {r[KEY].file: (r.n_rare, sorted((x.data or "" for x in r.rare))) for r in H.rare_by_case(df).collect()}
    assert got == {"f": (1, ["so aqui"]), "h": (2, ["", "outra"])}


def test_unused_header_columns_are_not_dealt(cases):
    plan = _plan(header_table(cases).select("info_status"))
    assert "situacao" in plan and "valor_da_acao" not in plan


def test_records_of_a_case_stand_in_order(spark):
    # records without a place in a file: by position, then value; alone: as they stand
    data = [("Classe", "z"), ("Relator", "a"), ("Relator", None)], [("Classe", "b"), ("Relator", "a")]
    rows = [("f", "result", ("1", d, [], [], [])) for d in data] + [("g", "result", ("2", data[0], [], [], []))]
    got = {r.file: (r.classe, r.relator) for r in H.header_wide(spark.createDataFrame(rows, CASES_SCHEMA)).collect()}
    assert got == {"f": ("b@z", "a@NA"), "g": ("z", "a@NA")}


def test_newest_fetch_is_found_unsorted(spark):
    t = [dt.datetime(2020, 1, 1, h) for h in (8, 20)]

    def row(file, day, read, batch):
        return (file, day and dt.date(2020, 1, day), read, "result", None, 0, "x", "y", batch)
    log = spark.createDataFrame([row("a", 1, None, 0), row("a", 1, t[0], 0), row("b", 1, t[1], 0), row("b", 1, t[1], 1), row("c", 2, None, 0), row("d", None, t[0], 0)], LOG_SCHEMA)
    got = newest_fetch(log)
    assert "SortAggregate" not in _plan(got)
    assert sorted((r.file, r.batch) for r in got.collect()) == [("b", 1), ("c", 0), ("d", 0)]


def test_plain_pages_take_few_steps_a_tag():
    page = ("<table><tr><th>Data</th><th>Movimento</th></tr><tbody id='tabelaTodasMovimentacoes'>"
            + "<tr class='a'><td class='b'>01/02/2003</td><td class='c'>t</td></tr>" * 200 + "</table>")
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        rows = movement_rows(page)
    finally:
        sys.setprofile(None)
    assert rows == [("01/02/2003", "t")] * 200
    # start and end tags: 3 rows' worth of them each
    assert calls < 30 * 6 * 200, calls


def test_tags_met_before_are_not_read_again():
    # the regexes and lookups of a tag are done once for all pages that share it
    row = "<tr class='a'><td class='b'>01/02/2003</td><td class='c'>t</td></tr>"
    page = "<div><table><tr><th>Data</th><th>Movimento</th></tr><tbody id='tabelaTodasMovimentacoes'>" + row * 200 + "</table></div><p>fim</p>"
    seen, calls = {}, 0
    movement_rows(page, seen)

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        rows = movement_rows(page, seen)
    finally:
        sys.setprofile(None)
    assert rows == [("01/02/2003", "t")] * 200
    assert calls < 13 * 6 * 200, calls


def test_kept_tags_are_bounded():
    seen = {}
    for k in range(3):
        page = "".join(f"<a href='{k}/{i}'>" for i in range(15_000)) + f"<b title='{'x' * 1000}'>"
        with pytest.raises(ValueError):
            movement_rows(page, seen)
    assert 0 < len(seen["tags"]) <= 10_000 and max(map(len, seen["tags"])) <= 300


@pytest.mark.parametrize("pieces", [["<table>", "<tr>", "<td>", "</td>", "</tr>", "</table>", "<td colspan=2>", "<td rowspan=2>", "x", "<br>", "<p>", "</p>"],
                                    ["<table>", "</table>", "<tr>", "<td/>", "<th>", "<div>", "</div>", "<thead>", "<tbody>", "</tbody>", "<!-- x -->", "y", "<p id=tabelaTodasMovimentacoes>"],
                                    ["<table>", "<td>", "<", "<script>", "</script>", "<!--", "<style>a</style>", "<a title='>'>", "<p \"", "z", "</td>", "<o:p>"]])
def test_pages_cut_at_once_are_read_as_token_by_token(pieces):
    rnd = random.Random(len(pieces))
    tags, n = {}, 0
    for _ in range(2000):
        body = "".join(rnd.choices(pieces, k=rnd.randint(0, 25)))
        page = "<table><tr><th>Data<th>Movimento" + rnd.choice(["", "<tbody id='tabelaTodasMovimentacoes'><tr>"]) + body + rnd.choice(["", "</table>"]) + "<p>w"
        slow = MV._Tables()
        MV._scan(page, slow)
        slow.finish()
        quick = MV._tables(page, tags)
        assert (quick.target and (quick.target.rows, quick.target.heads)) == (slow.target and (slow.target.rows, slow.target.heads)), page
        n += slow.target is not None and len(slow.target.rows) > 1
    assert n > 200


def test_usual_dates_are_read_without_the_other_forms(spark):
    days = ["01/02/2003", "31/12/1999", "29/02/2000", "29/02/2001", "31-04-2010", "00/01/2010", "01.13.2010", "1/2/2003", "01/02/0999", "01/02/0000", "01/02/03",
            "01/02-2003", " 01/02/2003", "01/02/2003\n", "01/02/20033", None, ""]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = [r[0] for r in df.select(MV.parse_dmy(F.col("d")).cast("string")).collect()]
    assert got == ["2003-02-01", "1999-12-31", "2000-02-29", None, None, None, None, "2003-02-01", "0999-02-01", "0000-02-01", "2003-02-01",
                   "2003-02-01", "2003-02-01", "2003-02-01", None, None, None]
    assert "CASE WHEN RLIKE" in df.select(MV.parse_dmy(F.col("d")))._jdf.queryExecution().optimizedPlan().toString()


def test_streamed_pages_are_made_once(spark, sf_dir, monkeypatch):
    from docketflow.streaming import daily_ingest
    made = spark.sparkContext.accumulator(0)
    built = build_docket_pages(X.Fixtures(spark, sf_dir)).localCheckpoint()

    @F.udf("string")
    def counted(html):
        made.add(1)
        return html
    landed = []

    def run_once(spark, pages, *rest):
        landed.extend(spark.read.parquet(pages).select("file", "html").collect())
        return spark.createDataFrame([], daily_ingest.MOVEMENTS_SCHEMA)
    monkeypatch.setattr(R, "build_docket_pages", lambda fx: built.withColumn("html", counted("html")))
    monkeypatch.setattr(daily_ingest, "run_once", run_once)
    R.streamed_movements(spark, sf_dir)
    twice = built.where(F.day("sg_date") % 4 == 1)
    assert made.value == len(landed) == built.count() + twice.count()
    old = sorted((r.file, r.html or "") for r in landed if (r.file or "").startswith("old/"))
    assert old == sorted((f"old/{r.file}", r.html or "") for r in twice.where("file is not null").collect())


def test_pages_meet_records_in_tasks_that_grow(spark, sf_dir, cases, monkeypatch):
    monkeypatch.setattr(C, "ROWS_PER_TASK", 50)
    parsed = stored(MV.parse_pages(build_docket_pages(X.Fixtures(spark, sf_dir))), "test-parsed")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(MV.merge_movements(cases, parsed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    n = -(-cases.count() // 50)
    dealt = re.findall(r"Exchange hashpartitioning\(file[^,]*, (\d+)\)", plan)
    assert n > 8 and dealt == [str(n)] * 2, plan


def test_days_are_written_in_tasks_that_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "ROWS_PER_TASK", 100)
    df = spark.range(2000).select((F.col("id") % 7).cast("string").alias("x"), "id", F.lit(dt.date(2020, 1, 1)).alias("sg_date"))
    store.write_daily(df, str(tmp_path / "days"), order_cols=["id"])
    files = sorted(str(f) for f in (tmp_path / "days/sg_date=2020-01-01").glob("*.parquet"))
    assert len(files) == 20
    got = [[r.id for r in spark.read.parquet(f).collect()] for f in files]
    assert [x for ids in got for x in ids] == list(range(2000)) and max(map(len, got)) < 300


def test_each_saved_file_is_a_page(spark, sf_dir, tmp_path, monkeypatch):
    page = ("<p>pages/7.html</p><table><tr><th>Data</th><th>Movimento</th></tr><tbody id='tabelaTodasMovimentacoes'>"
            "<tr><td>01/02/2003</td><td>t</td></tr></table>")
    (tmp_path / "kind=page").mkdir()
    for name in ("a.html", "b.html"):
        (tmp_path / "kind=page" / name).write_text(page)
        os.utime(tmp_path / "kind=page" / name, (1_500_000_000, 1_500_000_000))
    monkeypatch.setattr(R, "_page_files", lambda spark, sf_dir: str(tmp_path))
    assert [tuple(r) for r in R.saved_pages(spark, sf_dir).collect()] == [("pages/7.html", "result", 1)] * 2

"""Public entry points end to end on small inputs."""

import datetime as dt
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from docketflow import api
from docketflow.plans.tidy import tidy_cases
from docketflow.sources.inputs import read_cases


def test_tidy_folder_equals_both_plans(spark, cases):
    d = tempfile.mkdtemp(prefix="cases-", dir="/tmp")
    cases.write.mode("overwrite").parquet(d + "/c")
    a = api.tidy_folder(spark, d + "/c")
    b = tidy_cases(read_cases(spark, d + "/c"))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect())) and len(a.columns) == 29


def test_name_operators(spark):
    df = spark.createDataFrame([("Banco Itau S/A",), ("Joao da Silva",), (None,)], "n string")
    fixed = df.select(api.fix_names("n").alias("f"))
    out = api.market_segments(api.fold_companies(fixed, "f"), "company")
    got = sorted((r.f, r.company, r.segment) for r in out.collect() if r.f)
    assert got == [("banco itau @s@a@", "regex_itau", "bancos_cartoes_financeiras"),
                   ("joao da silva", "joao da silva", "joao da silva")]


def test_day_batch(spark):
    root = tempfile.mkdtemp(prefix="day-", dir="/tmp")
    pages = os.path.join(root, "pages")
    os.makedirs(pages)
    table = ('<table><tr><th>Data</th><th></th><th>Movimento</th></tr>'
             '<tbody id="tabelaTodasMovimentacoes">'
             '<tr><td>05/03/2017</td><td></td><td>Autos conclusos\n\tao relator</td></tr>'
             '</tbody></table>')
    for name, html in [("page_1.html", table), ("page_2.html", "<html>sem tabela</html>"),
                       ("other.txt", table)]:
        with open(os.path.join(pages, name), "w") as f:
            f.write(html)
    with pytest.warns(UserWarning, match="2017-03-06"):
        status = api.day_batch(spark, pages, os.path.join(root, "store"), "2017-03-06", "*page*")
    assert sorted((os.path.basename(r.file), r["return"]) for r in status.collect()) == [
        ("page_1.html", "result"), ("page_2.html", "error")]
    store = spark.read.parquet(os.path.join(root, "store"))
    rows = [(os.path.basename(r.file), r.movement, r.title, r.txt, r.sg_date) for r in store.collect()]
    assert rows == [("page_1.html", dt.date(2017, 3, 5), "Autos conclusos", "ao relator",
                     dt.date(2017, 3, 6))]


def test_empty_rerun_clears_the_day(spark, tmp_path):
    from docketflow.sources.store import day_folder, write_daily, yesterday
    store, a, b = f"{tmp_path}/store", dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    schema = "n int, sg_date date"
    write_daily(spark.createDataFrame([(1, a), (2, b)], schema), store, days=[a, b])
    write_daily(spark.createDataFrame([], schema), store, days=[a])
    got = spark.read.schema(schema).parquet(store)
    assert [(r.n, r.sg_date) for r in got.collect()] == [(2, b)]
    write_daily(spark.createDataFrame([(3, b)], schema), store, days=[b])
    assert [r.n for r in spark.read.schema(schema).parquet(store).collect()] == [3]
    assert day_folder("/x", a) == "/x/sg_2020-01-01" and day_folder("/x") == f"/x/sg_{yesterday()}"


def test_large_day_is_split(spark, tmp_path):
    from docketflow.sources.store import write_daily
    # small partitions would be put together again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_daily(spark.range(20_000).selectExpr("id", "DATE'2020-01-01' AS sg_date"), f"{tmp_path}/s")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spark.read.parquet(f"{tmp_path}/s").inputFiles()) > 1


def test_pages_to_records_to_table(spark, tmp_path):
    from docketflow.sources.inputs import CASES_SCHEMA
    table = ('<meta charset="iso-8859-1"><table><tr><th>Data<th><th>Movimento<tbody id="tabelaTodasMovimentacoes">'
             "<tr><td>05/03/2017<td><td>Decisão\n\tao relator<tr><td>06/04/2017<td><td>Fim</table>")
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.html").write_bytes(table.encode("latin-1"))
    (pages / "b.html").write_bytes(b"<p>nada</p>")
    row = lambda f: (f, "result", (f[-6:], [("Relator", "X")], [("A", "Apelante", "Apelante")], [], []))
    cases = spark.createDataFrame([row(f"{pages}/a.html"), row(f"{pages}/b.html")], CASES_SCHEMA)
    store = f"{tmp_path}/store"
    api.day_cases(spark, cases, str(pages), store, "2017-03-06")
    kept = spark.read.parquet(store).collect()
    assert sorted((os.path.basename(r.file), r["return"], len(r.output.movs), str(r.sg_date)) for r in kept) == [
        ("a.html", "result", 2, "2017-03-06"), ("b.html", "error", 0, "2017-03-06")]
    movs = next(r.output.movs for r in kept if r["return"] == "result")
    assert (movs[0].movement, movs[0].title, movs[0].txt) == (dt.date(2017, 3, 5), "Decisão", "ao relator")


def test_changed_input_is_seen(spark, sf_dir, tmp_path):
    import shutil
    from docketflow.sources.inputs import _fingerprint
    for t in ("orders", "lineitem", "customer"):
        shutil.copy(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    old = _fingerprint(spark, str(tmp_path))
    assert old == _fingerprint(spark, str(tmp_path))
    os.chmod(tmp_path / "customer.parquet", 0o644)
    os.utime(tmp_path / "customer.parquet", (1, 1))
    assert old != _fingerprint(spark, str(tmp_path))


def test_age_overflow_is_null(spark):
    from docketflow.operators.profile import age_from_serial
    df = spark.createDataFrame([("1e12",), ("36526",), ("x",)], "s string")
    got = [r[0] for r in df.select(age_from_serial(F.col("s"), "2024-01-01")).collect()]
    assert got[0] is None and got[1] is not None and got[2] is None

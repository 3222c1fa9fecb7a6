"""The page stream: incremental, exactly once, a day fetched again replaces
the day, and errors are counted and warned of."""

import datetime as dt

import pytest

from docketflow import api
from docketflow.streaming.daily_ingest import LOG_SCHEMA, PAGES_SCHEMA, _replace_days, run_once, start_ingest

PAGE = ('<table><thead><tr><th>Data</th><th></th><th>Movimento</th></tr></thead>'
        '<tbody id="tabelaTodasMovimentacoes">{}</tbody></table>')
DAY1, DAY2 = dt.date(2017, 3, 1), dt.date(2017, 3, 2)
AT, LATER = dt.datetime(2017, 3, 1, 8), dt.datetime(2017, 3, 3, 8)


def _page(*rows):
    return PAGE.format("".join(f"<tr><td>{d}</td><td></td><td>{t}</td></tr>" for d, t in rows))


def _land(spark, pages, *rows, files=1):
    spark.createDataFrame(list(rows), PAGES_SCHEMA).repartition(files, "file").write.mode("append").parquet(pages)


def _rows(df):
    return sorted(((r.file, r.pos, r.movement, r.title, str(r.sg_date)) for r in df.collect()), key=str)


def test_incremental_exactly_once(spark, tmp_path):
    pages, store, ckpt = (f"{tmp_path}/{x}" for x in ("pages", "store", "ckpt"))
    _land(spark, pages, ("a.html", DAY1, _page(("01/03/2017", "Autos\n\tconclusos"), ("", "sem data")), None), ("b.html", DAY1, None, None))
    with pytest.warns(UserWarning, match="1 of 2 pages"):
        out = run_once(spark, pages, store, ckpt)
    assert [(r.file, r.pos, r.title, r.txt) for r in out.collect()] == [("a.html", 0, "Autos", "conclusos")]
    _land(spark, pages, ("c.html", DAY2, _page(("31/02/2017", "Data ruim"), ("02-03-2017", "Publicado")), None))
    want = [("a.html", 0, dt.date(2017, 3, 1), "Autos", "2017-03-01"), ("c.html", 0, None, "Data ruim", "2017-03-02"),
            ("c.html", 1, dt.date(2017, 3, 2), "Publicado", "2017-03-02")]
    assert _rows(run_once(spark, pages, store, ckpt)) == sorted(want, key=str)
    assert _rows(run_once(spark, pages, store, ckpt)) == sorted(want, key=str)  # nothing new


def test_a_day_fetched_again_is_replaced(spark, tmp_path):
    """Equal to the batch job on the second fetch's pages: a page that is no
    longer there is gone, also where the fetch comes in many batches."""
    pages, store, ckpt = (f"{tmp_path}/{x}" for x in ("pages", "store", "ckpt"))
    _land(spark, pages, *((f"{k}.html", DAY1, _page(("01/03/2017", f"antes {k}")), AT) for k in "abc"), ("z.html", DAY2, _page(("02/03/2017", "fica")), AT))
    run_once(spark, pages, store, ckpt)
    second = {"a": _page(("02/03/2017", "depois a"), ("03/03/2017", "mais")), "b": "<p>nada</p>", "d": _page(("04/03/2017", "novo"))}
    _land(spark, pages, *((f"{k}.html", DAY1, html, LATER) for k, html in second.items()), files=6)
    with pytest.warns(UserWarning):
        got = run_once(spark, pages, store, ckpt, max_files_per_trigger=1)
    folder = tmp_path / "saved"
    folder.mkdir()
    for k, html in second.items():
        (folder / f"{k}.html").write_text(html)
    with pytest.warns(UserWarning):
        api.day_batch(spark, str(folder), f"{tmp_path}/batch", DAY1)
    batch = [(f.rsplit("/", 1)[1], *rest) for f, *rest in _rows(spark.read.parquet(f"{tmp_path}/batch"))]
    assert _rows(got.where("sg_date = '2017-03-01'")) == sorted(batch, key=str) and len(batch) == 3
    assert [r.title for r in got.where("sg_date = '2017-03-02'").collect()] == ["fica"]
    # an older fetch that lands late changes nothing
    _land(spark, pages, ("e.html", DAY1, _page(("01/03/2017", "velho")), AT))
    assert _rows(run_once(spark, pages, store, ckpt).where("sg_date = '2017-03-01'")) == sorted(batch, key=str)


def test_a_fetch_without_movements_empties_the_day(spark, tmp_path):
    pages, store, ckpt = (f"{tmp_path}/{x}" for x in ("pages", "store", "ckpt"))
    _land(spark, pages, ("a.html", DAY1, _page(("01/03/2017", "x")), AT))
    assert run_once(spark, pages, store, ckpt).count() == 1
    _land(spark, pages, ("a.html", DAY1, None, LATER))
    with pytest.warns(UserWarning):
        assert run_once(spark, pages, store, ckpt).count() == 0


def test_a_batch_may_be_repeated(spark, tmp_path):
    """A batch that failed after its log, or after its days, is run again."""
    from docketflow.operators.movements import parse_pages
    write = _replace_days(f"{tmp_path}/store", f"{tmp_path}/log")
    rows = [("a.html", DAY1, _page(("01/03/2017", "x")), AT), ("a.html", DAY2, _page(("01/03/2017", "y")), AT)]
    batch = parse_pages(spark.createDataFrame(rows, PAGES_SCHEMA).withColumnRenamed("fetch", "read"))
    for batch_id in (0, 0, 1, 0, 1):
        write(batch, batch_id)
    assert sorted(r.title for r in spark.read.parquet(f"{tmp_path}/store").collect()) == ["x", "y"]
    assert spark.read.schema(LOG_SCHEMA).parquet(f"{tmp_path}/log").count() == 4


def test_stream_metrics(spark, tmp_path):
    pages, store, ckpt = (f"{tmp_path}/{x}" for x in ("pages", "store", "ckpt"))
    _land(spark, pages, ("a.html", DAY1, _page(("01/03/2017", "x"), ("02/03/2017", "y")), AT), ("b.html", DAY1, None, AT))
    with pytest.warns(UserWarning):
        q = start_ingest(spark, pages, store, ckpt)
        q.awaitTermination()
    seen = [p["observedMetrics"]["page_status"] for p in q.recentProgress if p["observedMetrics"]]
    assert [(s["n_pages"], s["n_error"], s["n_movements"]) for s in seen] == [(2, 1, 2)]

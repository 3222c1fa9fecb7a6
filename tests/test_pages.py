"""HTML movement-table parsing (P5) and the saved-page reader."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from docketflow.operators.movements import movement_rows, snake_names
from docketflow.sources.pages import read_saved_pages

T = ('<html><body><table><tr><td>outra</td></tr></table>'
     '<table><thead><tr><th>Data</th><th></th><th>Movimento</th></tr></thead>'
     '<tbody id="tabelaTodasMovimentacoes">{}</tbody></table></body></html>')


def test_rows_of_the_movements_table():
    html = T.format('<tr><td> 01/02/2003 </td><td></td><td>\nTitulo\n\tCorpo</td></tr>'
                    '<tr><td></td><td></td><td>Sem data</td></tr>'
                    '<tr><td>05/06/2007</td></tr>')
    assert movement_rows(html) == [("01/02/2003", "Titulo\n\tCorpo"), ("", "Sem data"),
                                   ("05/06/2007", None)]


def test_no_movements_table_is_an_error():
    with pytest.raises(ValueError):
        movement_rows("<html><table><tr><td>x</td></tr></table></html>")


def test_end_tags_left_out():
    assert movement_rows(T.format("<tr><td>1<td><td>A<tr><td>2<td><td>B")) == [("1", "A"), ("2", "B")]
    assert movement_rows(T.format("<tr><td>1</td><td></td><td>A</td><tr><td>2</td><td></td><td>B</td></tr>")) == [("1", "A"), ("2", "B")]
    assert movement_rows(T.format("<td>1<td><td>A")) == [("1", "A")]
    cut = T.format("<tr><td>1<td><td>A")
    assert movement_rows(cut[:cut.index("</tbody>")]) == [("1", "A")]


def test_cells_that_span():
    assert movement_rows(T.format('<tr><td>1</td><td colspan=2>A</td></tr>')) == [("1", "A")]
    assert movement_rows(T.format('<tr><td rowspan="2">1</td><td></td><td>A</td></tr><tr><td></td><td>B</td></tr>')) == [("1", "A"), ("1", "B")]
    assert movement_rows(T.format('<tr><td rowspan=0>1</td><td></td><td>A</td></tr><tr><td></td><td>B</td></tr><tr><td><td>C')) == [
        ("1", "A"), ("1", "B"), ("1", "C")]


def test_stray_end_tags_inside_a_cell():
    assert movement_rows("<div>" + T.format("<tr><td>1</div></td><td><td>A")) == [("1", "A")]


def test_nested_table_stays_in_its_cell():
    assert movement_rows(T.format("<tr><td>1<td><td>A<table><tr><td>x<td>y</table>B<tr><td>2<td><td>C")) == [("1", "AxyB"), ("2", "C")]


@pytest.mark.parametrize("charset, declared", [("latin-1", "iso-8859-1"), ("cp1252", "windows-1252"), ("utf-8", "utf-8"), ("cp1252", None),
                                               ("utf-8", None), ("utf-16", None)])
def test_charsets(charset, declared):
    from docketflow.operators.movements import decode_page
    html = (f'<meta http-equiv=x content="text/html; charset={declared}">' if declared else "") + "Título"
    assert decode_page(html.encode(charset)).endswith("Título")


def test_table_without_columns_raises():
    html = ('<table><tbody id="tabelaTodasMovimentacoes"><tr><th>A</th><th>B</th></tr>'
            '<tr><td>1</td><td>2</td></tr></tbody></table>')
    with pytest.raises(ValueError):
        movement_rows(html)


def test_snake_names():
    assert snake_names(["Data", "", "Movimento", "Data"]) == ["data", "x", "movimento", "data_2"]


def test_saved_pages_reader_filters_names(spark, tmp_path):
    for n in ("page_1.html", "page 2.html", "other.html"):
        (tmp_path / n).write_bytes(f"<html>\n{n}\n</html>".encode())
    got = sorted((r.file, bytes(r.html)) for r in read_saved_pages(spark, str(tmp_path), "*page*").collect())
    assert got == [(f"{tmp_path}/{n}", f"<html>\n{n}\n</html>".encode()) for n in ("page 2.html", "page_1.html")]


def test_day_month_year_parse(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from docketflow.operators.movements import parse_dmy
    vals = ["01/02/2017", " 1/2/2017 ", "01-02-2017", "01.02.2017", "01/02/17", "01/02/69",
            "31/02/2017", "", "sem data", None]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(parse_dmy(F.col("t"))).collect()]
    d = dt.date
    assert got == [d(2017, 2, 1), d(2017, 2, 1), d(2017, 2, 1), d(2017, 2, 1), d(2017, 2, 1),
                   d(1969, 2, 1), None, None, None, None]


def test_tokenizer_matches_stdlib_parser():
    """The regex tokenizer feeds the table collector exactly what the
    stdlib HTML parser would, on randomly assembled pages."""
    import random
    from html.parser import HTMLParser

    from docketflow.operators import movements as MV

    class Std(HTMLParser):
        def __init__(self, sink):
            super().__init__(convert_charrefs=True)
            self.sink = sink

        def handle_starttag(self, tag, attrs):
            self.sink.handle_starttag(tag, dict(attrs).get("id"), "")
            if tag in MV._VOID:
                self.sink.handle_endtag(tag)

        def handle_startendtag(self, tag, attrs):
            self.sink.handle_starttag(tag, dict(attrs).get("id"))
            self.sink.handle_endtag(tag)

        def handle_endtag(self, tag):
            self.sink.handle_endtag(tag)

        def handle_data(self, data):
            self.sink.handle_data(data)

    def found(t):
        t.finish()
        return t.target and (t.target.rows, t.target.heads)

    def via_std(page):
        t = MV._Tables()
        p = Std(t)
        p.feed(page)
        p.close()
        return found(t)

    def via_regex(page):
        t = MV._Tables()
        MV._scan(page, t)
        return found(t)

    rnd = random.Random(3)
    bits = ['<table class="x"><tr><td>decoy</td></tr></table>', "<!-- <table> -->",
            '<script>var s = "<table><tr>";</script>', '<div title="a > b">t</div>', "<br>",
            "<p>Sem &amp; com&nbsp;espaço</p>", "<img src='x.png'/>"]
    rows = ['<tr><td>0{d}/03/2017</td><td></td><td>T&iacute;tulo {d}\n\tcorpo</td></tr>',
            '<tr><td> </td><td></td><td>sem data</td></tr>', '<tr><td>1{d}/04/2016</td></tr>']
    for _ in range(300):
        body = "".join(rnd.choice(rows).format(d=rnd.randint(1, 9)) for _ in range(rnd.randint(0, 4)))
        head = '<tr><th>Data</th><th></th><th>Movimento</th></tr>' if rnd.random() < .8 else ""
        table = f'<table><thead>{head}</thead><tbody id="tabelaTodasMovimentacoes">{body}</tbody></table>'
        pieces = [rnd.choice(bits) for _ in range(rnd.randint(0, 4))]
        pieces.insert(rnd.randint(0, len(pieces)), table if rnd.random() < .9 else "")
        page = "<html><body>" + "".join(pieces) + "</body></html>"
        assert via_regex(page) == via_std(page), page


def test_charset_after_a_long_head():
    from docketflow.operators.movements import decode_page
    page = "<head><style>" + "x" * 20_000 + "</style><meta charset=iso-8859-2></head><body>ł</body>"
    assert decode_page(page.encode("iso-8859-2")) == page


# -- pages saved more than once -------------------------------------------------

def _movement_page(*texts):
    rows = "".join(f"<tr><td>0{i + 1}/03/2017</td><td>{t}</td></tr>" for i, t in enumerate(texts))
    return f'<table><thead><tr><th>Data</th><th>Movimento</th></tr></thead><tbody id="tabelaTodasMovimentacoes">{rows}</tbody></table>'


def test_one_page_for_each_record(spark):
    """The newest page of a file, as of a day, or the page of the record's own
    day; never two records for two pages, never one with both's movements."""
    import datetime as dt
    from docketflow.operators.movements import merge_movements, parse_pages
    from docketflow.sources.inputs import CASES_SCHEMA
    d = [dt.date(2017, 3, n) for n in range(1, 5)]
    at = lambda day, hour: dt.datetime(2017, 3, day, hour)
    pages = [("a", d[0], at(1, 8), _movement_page("a1")), ("a", d[1], at(2, 8), _movement_page("a2 early")), ("a", d[1], at(2, 20), _movement_page("a2", "a2b")),
             ("a", d[3], at(4, 8), _movement_page("a4")), ("b", d[0], at(1, 8), _movement_page("b1")), ("b", d[1], at(2, 8), "<p>nada</p>"),
             ("c", d[0], None, _movement_page()), (None, d[0], at(1, 8), _movement_page("no file"))]
    parsed = parse_pages(spark.createDataFrame(pages, "file string, sg_date date, read timestamp, html string"))
    row = lambda f: (f, "result", (f, [], [], [(None, "old", None)], []))
    cases = spark.createDataFrame([row(f) for f in ("a", "b", "c", "d", None)], CASES_SCHEMA)

    def got(df):
        return sorted(((r.file, r["return"], [m.title for m in r.output.movs], r.sg_date) for r in df.collect()), key=str)
    rest = [("d", "result", ["old"], None), (None, "result", ["old"], None)]
    assert got(merge_movements(cases, parsed)) == sorted(
        [("a", "result", ["a4"], d[3]), ("b", "error", [], d[1]), ("c", "result", [], d[0]), *rest], key=str)
    assert got(merge_movements(cases, parsed, as_of=d[2])) == sorted(
        [("a", "result", ["a2", "a2b"], d[1]), ("b", "error", [], d[1]), ("c", "result", [], d[0]), *rest], key=str)
    days = spark.createDataFrame([(x,) for x in d[:3]], "sg_date date")
    own = cases.where("file in ('a', 'b')").join(days, F.lit(True))
    assert got(merge_movements(own, parsed)) == sorted(
        [("a", "result", ["a1"], d[0]), ("a", "result", ["a2", "a2b"], d[1]), ("a", "result", ["old"], d[2]),
         ("b", "result", ["b1"], d[0]), ("b", "error", [], d[1]), ("b", "result", ["old"], d[2])], key=str)


def test_files_by_regex_and_packed(spark, tmp_path):
    from docketflow.sources.pages import read_saved_pages
    for k in range(150):
        (tmp_path / f"{'page' if k % 3 else 'index'}_{k:03d}.html").write_text(f"n{k}")
    all_ = read_saved_pages(spark, str(tmp_path))
    some = read_saved_pages(spark, str(tmp_path), name_regex=r"page_0\d[05]")
    assert all_.count() == 150 and all(r.file.startswith("/") for r in all_.collect())
    assert sorted(bytes(r.html).decode() for r in some.collect()) == sorted(f"n{k}" for k in range(0, 100, 5) if k % 3)
    assert read_saved_pages(spark, str(tmp_path), name_regex="nowhere").collect() == []
    (tmp_path / "odd").mkdir()
    for name in ("page [1].html", "page {a,b}*.html", "page ?\\.html", "other.html"):
        (tmp_path / "odd" / name).write_text(name)
    odd = read_saved_pages(spark, str(tmp_path / "odd"), name_regex="page")
    assert sorted(bytes(r.html).decode() for r in odd.collect()) == ["page ?\\.html", "page [1].html", "page {a,b}*.html"]
    assert all_.rdd.getNumPartitions() > 1
    assert read_saved_pages(spark, str(tmp_path), partition_bytes=1 << 20).rdd.getNumPartitions() == 1
    assert read_saved_pages(spark, str(tmp_path), partition_bytes=300_000).rdd.getNumPartitions() == 3


@pytest.mark.parametrize("text, want", [
    ("05032017", "2017-03-05"), ("050317", "2017-03-05"), ("5 mar 2017", "2017-03-05"), ("5 de março de 2017", "2017-03-05"), ("05-MAR-2017", "2017-03-05"),
    ("5mar2017", "2017-03-05"), ("1 dezembro 99", "1999-12-01"), ("3 May, 2001", "2001-05-03"), ("1/2/68", "2068-02-01"), ("1/2/69", "1969-02-01"),
    ("1. 2. 2003", "2003-02-01"), ("1_2_2003", "2003-02-01"), ("31022017", None), ("31 fev 2017", None), ("5 foo 2017", None), ("532017", None),
    ("5/3", None), ("05/03/20177", None), ("2017-03-05", None), ("", None), (None, None), ("99/99/9999", None)])
def test_day_month_year(spark, text, want):
    from docketflow.operators.movements import parse_dmy
    got = spark.createDataFrame([(text,)], "t string").select(parse_dmy(F.col("t")).cast("string")).first()[0]
    assert got == want


@pytest.mark.parametrize("piece", ['<p "', "<p>", "<table><td>", "</b><p>", "<thead></thead><p>", "<td rowspan=0>x", "<!--"])
def test_a_broken_page_ends(piece):
    import time
    from docketflow.operators.movements import movement_rows
    start = time.perf_counter()
    with pytest.raises(ValueError):
        movement_rows("<table>" + piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 10


def test_charset_of_a_short_head():
    from docketflow.operators.movements import decode_page
    page = "<head><title>é</title></head><body>" + '<meta charset="utf-16">' + "é" * 9000
    assert decode_page(page.encode()) == page


def _forks():
    with open("/proc/stat") as f:
        return next(int(x.split()[1]) for x in f if x.startswith("processes"))


@pytest.mark.skipif(not os.path.exists("/proc/stat"), reason="counts processes as Linux does")
def test_page_files_need_no_process_each(spark, tmp_path):
    from docketflow.sources.pages import write_page_files
    n = 3000
    pages = spark.range(0, n, 1, 4).select(F.concat(F.lit("página\n"), F.col("id").cast("string")).alias("html"))
    begun = _forks()
    write_page_files(pages, str(tmp_path / "a folder"), F.lit("page"))
    assert _forks() - begun < n
    found = read_saved_pages(spark, str(tmp_path / "a folder"), recursive=True, partition_bytes=1 << 20).select("html").collect()
    assert sorted(bytes(r.html).decode() for r in found) == sorted(f"página\n{k}\n" for k in range(n))


def test_page_files_stand_where_spark_puts_them(spark, tmp_path):
    from docketflow.sources.pages import write_page_files
    kinds = [None, "", "page", "a/b: c=%1", "é"]
    rows = [(f"{k}", k) for k in kinds] + [("again", "page")] * 2 + [(None, "page"), ("", "page")]
    df = spark.createDataFrame(rows, "html string, kind string")
    write_page_files(df, str(tmp_path / "ours"), F.col("kind"))
    df.where("html is not null").selectExpr("html as value", "kind").write.partitionBy("kind").option("maxRecordsPerFile", 1).text(str(tmp_path / "spark"))

    def seen(at):
        return sorted((r.file.split("/kind=")[1].split("/")[0], bytes(r.html)) for r in read_saved_pages(spark, str(at), recursive=True).collect())
    assert seen(tmp_path / "ours") == seen(tmp_path / "spark")
    with pytest.raises(FileExistsError):
        write_page_files(df, str(tmp_path / "ours"), F.col("kind"))
    write_page_files(df.where("false"), str(tmp_path / "none"), F.col("kind"))
    assert read_saved_pages(spark, str(tmp_path / "none"), recursive=True, partition_bytes=1 << 20).collect() == []


def test_a_task_that_runs_again_leaves_each_page_once(spark, tmp_path, monkeypatch):
    import types

    import pyarrow as pa

    from docketflow.sources import pages as P
    batch = pa.RecordBatch.from_pydict({"value": ["a", "a", "b"], "kind": ["x", "y", "x"]})

    def attempt(k, batches):
        context = types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 7, taskAttemptId=lambda: k))
        monkeypatch.setattr(P, "TaskContext", context)
        return [b.column("n").to_pylist() for b in P._write_files(str(tmp_path))(batches)]

    def fails():
        yield batch.slice(0, 2)
        raise OSError("lost")
    with pytest.raises(OSError):
        attempt(1, fails())
    (tmp_path / "kind=x/00007/.2.1").write_text("half")
    assert attempt(2, iter([batch])) == [[3]]
    assert sorted(bytes(r.html) for r in read_saved_pages(spark, str(tmp_path), recursive=True).collect()) == [b"a\n", b"a\n", b"b\n"]

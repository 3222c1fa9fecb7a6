"""Saved docket pages and search-index pages.

* :func:`build_docket_pages` renders one HTML page per fetched file from
  the page-row fixture (Spark only; the oracle reads the rows directly);
* :func:`build_search_pages` groups the search-index rows into pages of
  20 results, the nested shape a search parser returns;
* :func:`build_saved_again` adds copies of some pages that were saved
  earlier, earlier the same day, or after the day of interest;
* :func:`write_page_files` saves pages one file each;
* :func:`read_saved_pages` reads a folder of saved files, keeping those whose
  path matches a regex (or whose name a glob), with the absolute path as
  ``file``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyarrow.fs import FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import Fixtures, by_order, page_file, page_rows
from .store import open_store, store_uri

# Files are written in Python workers, which may not have this package
# installed: ship this module's code with the task instead of by reference.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
    _cp.register_pickle_by_value(sys.modules[open_store.__module__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

# --- fixed values -----------------------------------------------------------
RESULTS_PER_PAGE = 20
# ----------------------------------------------------------------------------

_HEAD = ('<!DOCTYPE html><html><head><meta charset="utf-8"><title>Consulta</title></head>'
         '<body><h2 class="subtitle">Dados do processo</h2>'
         '<table class="secaoFormBody"><tr><th>Processo</th></tr><tr><td>%s</td></tr></table>'
         '<h2 class="subtitle">Movimentações</h2>'
         '<table style="margin-left:15px"><thead><tr><th>Data</th><th></th><th>Movimento</th></tr>'
         '</thead><tbody id="tabelaTodasMovimentacoes">')
_TAIL = '</tbody></table></body></html>'


def build_docket_pages(fx: Fixtures) -> DataFrame:
    """``file, sg_date, html`` per fetched file (NULL html = unreadable)."""
    def row(r):
        title = F.when(r["nbsp"] == 1, F.regexp_replace(r["title"], " ", "&nbsp;")).otherwise(r["title"])
        cell = F.concat(title, F.when(r["body"].isNotNull(), F.concat(F.lit("\n\t"), r["body"])).otherwise(F.lit("")))

        # some pages leave out end tags, some let the text span the empty column
        def shaped(end_cell: str, end_row: str, between: str):
            return F.concat(F.lit('<tr class="fundoClaro"><td width="120" class="dataMovimentacao">'), r["date_txt"],
                            F.lit(end_cell + between.format(end_cell)), cell, F.lit(end_cell + end_row + "\n"))

        return (F.when((k % 3 == 1) & (k % 4 == 2), shaped("", "", across)).when(k % 3 == 1, shaped("", "", apart))
                .when(k % 4 == 2, shaped("</td>", "</tr>", across)).otherwise(shaped("</td>", "</tr>", apart)))

    apart, across = '<td valign="top"> {}<td class="descricaoMovimentacao">\n', '<td colspan="2" class="descricaoMovimentacao">\n'
    k = F.col("k")
    orders = by_order(fx)
    # orders without a key have pages without rows
    trs = F.when(k.isNull(), F.lit("")).otherwise(F.array_join(F.transform(F.expr(page_rows()), row), ""))
    file, shape = page_file()
    pages = orders.select("k", file.alias("file"), shape.alias("shape"), trs.alias("trs"), F.explode("orders").alias("o"))
    shape, head = F.col("shape"), F.format_string(_HEAD, F.col("file"))
    html = (F.when(shape == "missing", F.lit(None).cast("string"))
            .when(shape == "no_table",
                  F.format_string('<html><body><p>%s sem movimentações</p></body></html>',
                                  F.col("file")))
            .otherwise(F.concat(head, "trs", F.lit(_TAIL))))
    return pages.select("file", F.col("o.o_orderdate").cast("date").alias("sg_date"), html.alias("html"))


def build_search_pages(fx: Fixtures) -> DataFrame:
    """``sg_date, page, id, return, output ARRAY<STRUCT<id_lawsuit, n_result>>``:
    each day's search results in pages of at most 20 (by result number)."""
    ix = fx.fx_index.withColumn("page", (F.col("k") / RESULTS_PER_PAGE).cast("bigint"))
    g = ix.groupBy("sg_date", "page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "id_lawsuit"))),
                    lambda x: F.struct(x["id_lawsuit"].alias("id_lawsuit"),
                                       x["k"].alias("n_result"))).alias("output"))
    return g.select("sg_date", "page",
                    F.concat_ws("-", F.col("sg_date").cast("string"),
                                F.col("page").cast("string")).alias("id"),
                    F.lit("result").alias("return"), "output")


def build_saved_again(pages: DataFrame) -> DataFrame:
    """``pages`` as read at 20 o'clock of their day, with other copies beside
    them: some of the day before, some of the same day's morning, some of a
    far later day.  The copies hold one movement of their own, or none."""
    number = F.crc32("file")
    at = F.col("sg_date").cast("timestamp")
    row = '<tr><td>09/09/2019</td><td></td><td>Outro\n\tdia</td></tr>'
    html = F.when(number % 2 == 0, F.concat(F.format_string(_HEAD, F.col("file")), F.lit(row + _TAIL))).otherwise(F.lit("<p>nada</p>"))
    hour = F.expr("INTERVAL 1 HOUR")
    copies = [("sg_date", at + 20 * hour, F.col("html"), F.lit(True)), (F.date_sub("sg_date", 1), at - 2 * hour, html, number % 4 == 1),
              ("sg_date", at + 8 * hour, html, number % 5 == 2), (F.lit("2100-01-01").cast("date"), at, html, number % 6 == 3)]
    saved = F.explode(F.filter(F.array(*(F.when(cond, F.struct((F.col(d) if isinstance(d, str) else d).alias("sg_date"), r.alias("read"), h.alias("html")))
                                         for d, r, h, cond in copies)), lambda x: x.isNotNull()))
    return pages.select("file", saved.alias("s")).select("file", "s.*")


def _folder_name(kind: str | None) -> str:
    """``kind`` as the folder that Spark's ``partitionBy`` gives it."""
    return "kind=" + (re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", kind) if kind else "__HIVE_DEFAULT_PARTITION__")


def _write_files(uri: str):
    """Writer of a task's pages: ``value, kind`` -> number of files.  A file
    appears whole or not at all."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(uri)
        task, made, n = TaskContext.get(), set(), 0
        for batch in batches:
            values = batch.column("value").cast(pa.large_binary())
            for value, kind in zip(values, batch.column("kind").to_pylist()):
                folder = f"{root}/{_folder_name(kind)}/{task.partitionId():05d}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                begun = f"{folder}/.{n}.{task.taskAttemptId()}"
                with store.open_output_stream(begun, compression=None) as out:
                    out.write(value.as_buffer())
                    out.write(b"\n")
                store.move(begun, f"{folder}/{n}.txt")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})
    return write


def write_page_files(pages: DataFrame, folder: str, kind) -> None:
    """One file per page below ``kind=<kind>/<task>/`` of ``folder``; a page
    without content has no file.  Tasks write through ``pyarrow.fs``: Spark's
    file writers start a process or two for each file of a local folder.  A
    task's pages are in order, so one that runs again writes the same files."""
    spark = pages.sparkSession
    rows = pages.where(F.col("html").isNotNull()).select(F.col("html").alias("value"), kind.alias("kind"))
    uri = store_uri(spark, folder)
    store, root = open_store(uri)
    if store.get_file_info(root).type != FileType.NotFound:
        raise FileExistsError(root)
    store.create_dir(root, recursive=True)
    rows.sortWithinPartitions("value", "kind").mapInArrow(_write_files(uri), "n long").write.format("noop").mode("overwrite").save()


def read_saved_pages(spark: SparkSession, folder: str, name_glob: str | None = None, name_regex: str | None = None,
                     recursive: bool = False, partition_bytes: int | None = None) -> DataFrame:
    """S4/S5: each saved file as one row ``(file, html, read)``: its absolute
    path, its bytes, whose charset the page parser reads, and when it was
    saved.  ``name_regex`` keeps the paths that it is found in (e.g. ``page``),
    in the tasks; ``name_glob`` keeps matching names in the listing, so files
    that it drops are not opened.

    Spark plans a task for about 32 files, however small, as it counts 4 MB for
    opening one.  ``partition_bytes`` packs as many files in a task as hold so
    many bytes (a file counts for 4 kB at least), from the listing alone."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if name_glob:
        r = r.option("pathGlobFilter", name_glob)
    found = r.load(folder)
    if name_regex:
        found = found.where(F.col("path").rlike(name_regex))
    path = F.regexp_replace("path", "^file:/+", "/")
    pages = found.select(path.alias("file"), F.col("content").alias("html"), F.col("modificationTime").alias("read"))
    if partition_bytes:
        some = spark.sparkContext.defaultParallelism
        size = found.select("length").coalesce(some).agg(F.sum(F.greatest(F.col("length"), F.lit(4096)))).first()[0] or 0
        pages = pages.coalesce(max(1, ceil(size / partition_bytes)))
    return pages

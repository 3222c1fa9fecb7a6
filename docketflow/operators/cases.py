"""Case selection and unnesting (shared head of the tidy branches) and the
parse-status report.

* ``return != 'error'`` keeps parsed cases (a NULL status is dropped too);
* the record struct is expanded and ONE nested array is exploded with its
  position (``posexplode``, inner: empty arrays give no rows), so that
  order-sensitive steps downstream can sort by ``pos``.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ok_cases(cases: DataFrame) -> DataFrame:
    return cases.filter(F.col("return") != "error")


#: Ordinal of an input row, added by :func:`read_cases`; it orders the rows of
#: a lawsuit that spans several of them, ahead of array positions.
SOURCE_ROW = "src_row"
#: The lawsuit a row belongs to.  As a struct it is never NULL and equal NULL
#: fields are equal, so a case without a number or file joins like any other.
KEY = "case_key"


def source_row() -> Column:
    """``(file path, row index)`` from the scan's metadata.  Paths below one
    folder compare as their relative parts do, so a copy of the folder keeps
    the order of its rows."""
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.row_index").alias("idx")).alias(SOURCE_ROW)


def order_column(cases: DataFrame) -> Column:
    """The ordinal if the input has one, else one constant: rows that come
    from no file scan have no order among themselves."""
    if SOURCE_ROW in cases.columns:
        return F.col(SOURCE_ROW)
    return F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("idx")).alias(SOURCE_ROW)


def key_column(cases: DataFrame) -> Column:
    """The case key of input rows: the stored one if there is one, whose
    bucketing the branches then keep, else number and file packed."""
    if KEY in cases.columns:
        return F.col(KEY)
    return F.struct(F.col("output.id1").alias("n_processo"), F.col("file")).alias(KEY)


ROWS_PER_TASK = 100_000


def case_tasks(cases: DataFrame) -> int:
    """So many tasks that each gets about as many records however large the
    input is."""
    n = int(cases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, ceil(cases.count() / ROWS_PER_TASK))


def beside_their_case(rows: DataFrame, cases: DataFrame) -> DataFrame:
    """``rows`` made of ``cases``, one each, dealt by case key to
    :func:`case_tasks`; nothing is sorted or aggregated before.  Input that
    holds its key is dealt already."""
    if KEY in cases.columns:
        return rows
    return rows.repartition(case_tasks(cases), KEY)


def in_order(records: Column, array: str, field: str) -> Column:
    """``field`` of the elements of all ``records``' ``array``, in the order of
    the source, then of ``pos``, then of ``field`` itself.  Most cases are one
    record, whose elements stand in order already."""
    alone = F.transform(F.get(records, F.lit(0))[array], lambda x: x[field])
    placed = F.flatten(F.transform(records, lambda r: F.transform(r[array], lambda x: F.struct(
        r[SOURCE_ROW].alias("src"), x["pos"].alias("pos"), x[field].alias(field)))))
    return F.when(F.size(records) == 1, alone).otherwise(F.transform(F.sort_array(placed), lambda x: x[field]))


def per_case(rows: DataFrame, cases: DataFrame, count: str) -> DataFrame:
    """``case_key``, each array column of a case's ``rows`` as an array of
    structs ``src_row, <array>`` under its own name (one that is not used is
    then not dealt), and the sum of their ``count``."""
    arrays = [F.collect_list(F.struct(SOURCE_ROW, c)).alias(c) for c in rows.columns if c not in (KEY, SOURCE_ROW, count)]
    return beside_their_case(rows, cases).groupBy(KEY).agg(*arrays, F.sum(count).alias(count))


def carried(df: DataFrame) -> list[str]:
    """The case key, if the input has it as a column."""
    return [KEY] if KEY in df.columns else []


def with_key(df: DataFrame, id_col: str = "id1") -> DataFrame:
    """``id_col`` and ``file`` packed into the case key."""
    rest = [c for c in df.columns if c not in (id_col, "file", KEY)]
    if KEY in df.columns:
        return df.select(KEY, *rest)
    return df.select(F.struct(F.col(id_col).alias("n_processo"), F.col("file")).alias(KEY), *rest)


def without_key(df: DataFrame) -> DataFrame:
    """The case key's fields as ``n_processo`` and ``file`` again."""
    return df.select(f"{KEY}.n_processo", f"{KEY}.file", *[c for c in df.columns if c != KEY])


def unnest_child(cases: DataFrame, child: str, fields: list[str],
                 with_source_row: bool = False) -> DataFrame:
    """``id1, file, [case_key,] [src_row,] pos, <fields...>`` for one nested
    array.

    Only the named element fields are read: each ``output.<child>.<field>``
    is an array-of-field access that nested schema pruning pushes into the
    Parquet scan; the fields are zipped back into elements and exploded
    with their positions.
    """
    zipped = F.arrays_zip(*[F.col(f"output.{child}.{f}").alias(f) for f in fields])
    # Two projections on purpose: the generator then sees only top-level,
    # already pruned columns, so a filter placed above the explode cannot
    # pull the whole ``output`` struct back into the scan.
    keys = ["id1", "file", *carried(cases)] + ([SOURCE_ROW] if with_source_row else [])
    extra = [order_column(cases)] if with_source_row else []
    narrow = ok_cases(cases).select(F.col("output.id1").alias("id1"), F.col("file"), *carried(cases),
                                    *extra, zipped.alias("_arr"))
    exploded = narrow.select(*keys, F.posexplode("_arr").alias("pos", "x"))
    return exploded.select(*keys, "pos", *[F.col("x")[f].alias(f) for f in fields])


def ok_case_summary(cases: DataFrame) -> DataFrame:
    """One row per parsed case with the sizes of its nested parts."""
    o = ok_cases(cases)
    return o.select(
        F.col("output.id1").alias("n_processo"), "file",
        F.size("output.data").cast("bigint").alias("n_data"),
        F.size("output.parts").cast("bigint").alias("n_parts"),
        F.size("output.movs").cast("bigint").alias("n_movs"),
        F.size("output.decisions").cast("bigint").alias("n_decisions"))


def parse_status(cases: DataFrame) -> DataFrame:
    """Whole-table status counts (one row).  ``n_error > 0`` is the
    reference's "there were errors" warning condition."""
    r = F.col("return")
    return cases.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(r == "error").alias("n_error"),
        F.count_if(r.isNull()).alias("n_no_status"),
        F.count_if(r != "error").alias("n_ok"))

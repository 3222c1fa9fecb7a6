"""Public entry points, one per job a user of the original pipeline runs.

* :func:`tidy_folder` -- parsed case records in a folder -> 29-column table;
* :func:`fix_names`, :func:`fold_companies`, :func:`market_segments` --
  the party-name operators, on any DataFrame column;
* :func:`day_search` -- one day's search results -> the day's index and its
  lawsuit ids; :func:`day_batch` -- its saved docket pages -> movement rows in
  the day-partitioned store; :func:`day_cases` -> case records with their
  pages' movements; :func:`tidy_store` -- the table of all stored days.

The day jobs count pages and errors in the job that writes (no second pass)
and warn if there were errors.
"""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.names import display_name, fix_names as _fix_names, is_legal_person
from .operators.companies import company_label, label_distinct, segment_label
from .operators.cases import order_column
from .operators.movements import merge_movements, page_metrics, parse_pages, tidy_movements
from .operators.search import flatten_results, lawsuit_ids
from .plans.tidy_fast import tidy_cases_fast
from .session import stored
from .sources.inputs import read_case_days, read_cases, write_case_days
from .sources.pages import read_saved_pages
from .sources.store import write_daily, yesterday

__all__ = ["tidy_folder", "fix_names", "is_legal_person", "display_name", "fold_companies",
           "market_segments", "day_search", "day_batch", "day_cases", "tidy_store"]


def tidy_folder(spark: SparkSession, path: str, cut_time: float = 3) -> DataFrame:
    """Read parsed case records (nested ``cases`` schema, Parquet) from
    ``path`` and return the tidy table."""
    return tidy_cases_fast(read_cases(spark, path), cut_time)


def fix_names(c: Column | str) -> Column:
    """Company-name fix as a column expression."""
    return _fix_names(c)


def fold_companies(df: DataFrame, col: str, dst: str = "company") -> DataFrame:
    """Add ``dst``: the folded company label of ``col`` (computed once per
    distinct value)."""
    return label_distinct(df, col, lambda d: d.select(col, company_label(F.col(col)).alias(dst)))


def market_segments(df: DataFrame, col: str, dst: str = "segment") -> DataFrame:
    """Add ``dst``: the market segment of a folded label in ``col``."""
    return label_distinct(df, col, lambda d: d.select(col, segment_label(F.col(col)).alias(dst)))


def _parsed(pages: DataFrame, what: str) -> DataFrame:
    """The parsed pages as a stored table; warns of unreadable ones from the
    counts of the writing job."""
    seen = Observation()
    parsed = stored(parse_pages(pages).observe(seen, *page_metrics()), "parsed-pages")
    n = seen.get
    if n["n_error"]:
        warnings.warn(f"There were errors reading {n['n_error']} of {n['n_pages']} pages of {what}.", stacklevel=3)
    return parsed


def _day_pages(spark, pages_dir, day, name_glob, name_regex) -> DataFrame:
    pages = read_saved_pages(spark, pages_dir, name_glob, name_regex)
    return pages.withColumn("sg_date", F.lit(str(day)).cast("date"))


def day_search(spark: SparkSession, results: DataFrame, store_dir: str, day: dt.date | str | None = None) -> DataFrame:
    """One day's parsed search pages (``id, return, output ARRAY<STRUCT<
    id_lawsuit, ...>>``): their results are stored as the day's index,
    replacing it, and the day's lawsuit ids (digits only) are returned.  Pages
    whose status is ``error`` have no results; there is a warning of them."""
    day = day or yesterday()
    seen = Observation()
    pages = results.observe(seen, F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("return") == "error").alias("n_error"))
    found = stored(flatten_results(pages).withColumn("sg_date", F.lit(str(day)).cast("date")), "search-results")
    n = seen.get
    if n["n_error"]:
        warnings.warn(f"There were errors in {n['n_error']} of {n['n_pages']} search pages of {day}.", stacklevel=2)
    write_daily(found, store_dir, days=[day])
    return lawsuit_ids(found)


def day_batch(spark: SparkSession, pages_dir: str, store_dir: str, day: dt.date | str | None = None,
              name_glob: str | None = None, name_regex: str | None = None) -> DataFrame:
    """Parse one day's saved docket pages (one file per page; the day is
    yesterday unless given) and write the movement rows into the day's
    partition of ``store_dir``, replacing that day only.  Returns the pages'
    status rows (``return`` is ``'error'`` for unreadable pages) and warns if
    there are errors."""
    day = day or yesterday()
    parsed = _parsed(_day_pages(spark, pages_dir, day, name_glob, name_regex), day)
    write_daily(tidy_movements(parsed), store_dir, order_cols=["file", "pos"], days=[day])
    return parsed.where("coalesce(pos, 0) = 0").select("file", "sg_date", "return", "error")


def day_cases(spark: SparkSession, cases: DataFrame, pages_dir: str, store_dir: str, day: dt.date | str | None = None,
              name_glob: str | None = None, name_regex: str | None = None) -> None:
    """One day's case records (the nested ``cases`` schema, ``file`` naming the
    saved page) with the movements read from their pages, stored by day.  Warns
    if pages could not be read."""
    day = day or yesterday()
    parsed = _parsed(_day_pages(spark, pages_dir, day, name_glob, name_regex), day)
    if "src_row" not in cases.columns:
        cases = cases.select("*", order_column(cases))
    records = merge_movements(cases, parsed, as_of=day).withColumn("sg_date", F.coalesce("sg_date", F.lit(str(day)).cast("date")))
    write_case_days(records, store_dir, days=[day])


def tidy_store(spark: SparkSession, store_dir: str, cut_time: float = 3) -> DataFrame:
    """The tidy table of all stored days."""
    return tidy_cases_fast(read_case_days(spark, store_dir), cut_time)

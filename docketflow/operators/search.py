"""Search-index results: flatten the parsed pages and list lawsuit ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_results(pages: DataFrame) -> DataFrame:
    """P3: one row per search result; the page bookkeeping columns
    (``id``, ``return``, ``page``) are dropped."""
    return (pages.select("*", F.explode("output").alias("o"))
            .select("*", "o.*").drop("o", "output", "id", "return", "page"))


def lawsuit_ids(results: DataFrame) -> DataFrame:
    """P4: the day's distinct lawsuit ids, then digits only.  De-duplication
    runs on the raw spelling, so two spellings of one number both stay."""
    uniq = results.select("sg_date", "id_lawsuit").distinct()
    return uniq.select("sg_date", F.regexp_replace("id_lawsuit", "[^0-9]", "").alias("id_lawsuit"))

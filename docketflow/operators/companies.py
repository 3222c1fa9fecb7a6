"""Company folding and market segments (ordered rules, LAST match wins,
no match keeps the input).

Plan: classify each DISTINCT name once, then join the labels back.
``distinct`` is a hash aggregate with map-side partial aggregation, so a
name carried by a third of all rows collapses before the shuffle.  The
rule chain is a reversed first-match CASE, so a name stops at
its first (i.e. last-listed) hit.  Rules are found by the literals they need
(``functions.literals``): most names hold none and meet no rule, the others
meet ``contains`` and few regexes, so that names that are mostly different
stay cheap too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import last_rule
from ..functions.rules import COMPANY_RULES, SEGMENT_RULES
from ..functions.text import col


def company_label(c):
    return last_rule(col(c), COMPANY_RULES)


def segment_label(c):
    return last_rule(col(c), SEGMENT_RULES)


def label_distinct(df: DataFrame, src: str, derive) -> DataFrame:
    """Compute ``derive(distinct values of src)`` once per distinct value and
    join the result back on ``src``; NULL ``src`` gets NULLs, which is what
    every rule gives a NULL input.  Rows without a name carry a hash of the
    row as a second key, so they don't meet in one task.  No size is guessed:
    Spark broadcasts the labels by their bytes or splits a skewed join."""
    labels = derive(df.select(src).where(F.col(src).isNotNull()).distinct()).withColumn("_salt", F.lit(0).cast("bigint"))
    salt = F.when(F.col(src).isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))
    return df.withColumn("_salt", salt).join(labels, [src, "_salt"], "left").drop("_salt")

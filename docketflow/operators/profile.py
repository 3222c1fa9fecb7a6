"""Profile helpers the reference defines beside the pipeline: criminal
outcomes, ages from birth data, a first/last-name person key and display
titles of variable codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decisions import criminal_appeal_outcome, criminal_writ_outcome
from ..functions.rules import TITLES
from ..functions.text import squish, unaccent

# --- fixed values -----------------------------------------------------------
SERIAL_ORIGIN = "1900-01-01"
DAYS_PER_YEAR = 365.242
# ----------------------------------------------------------------------------


def criminal_outcomes(tidy: DataFrame) -> DataFrame:
    """Outcome of criminal appeals ("Recurso") and writs ("Writ")."""
    crim = tidy.filter(F.col("info_classe_crim").isin("Writ", "Recurso"))
    d = F.col("decision")
    out = F.when(F.col("info_classe_crim") == "Recurso", criminal_appeal_outcome(d)) \
           .otherwise(criminal_writ_outcome(d))
    return crim.select("n_processo", "file", "info_classe_crim", "decision",
                       out.alias("crim_outcome"))


def age_from_serial(serial: Column, as_of: str) -> Column:
    """Years between ``as_of`` and the day ``serial`` days after 1900-01-01."""
    days = serial.try_cast("double").try_cast("int")
    born = F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), days)
    return F.datediff(F.lit(as_of).cast("date"), born).cast("double") / F.lit(DAYS_PER_YEAR)


def age_from_year(text: Column, as_of: str) -> Column:
    """``year(as_of)`` minus the first four-digit run of the text."""
    year = F.regexp_substr(text, F.lit("[0-9]{4}")).try_cast("double")
    return F.lit(int(as_of[:4])).cast("double") - year


def person_key(name: Column) -> Column:
    """First and last letter runs of the upper, unaccented, squished name;
    a missing part prints ``NA``."""
    nm = squish(unaccent(F.upper(name)))
    first = F.regexp_substr(nm, F.lit("^[A-Z]+"))
    last = F.regexp_substr(nm, F.lit("[A-Z]+$"))
    return F.concat_ws(" ", F.coalesce(first, F.lit("NA")), F.coalesce(last, F.lit("NA")))


def title_of(code: Column) -> Column:
    expr = None
    for k, v in TITLES:
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr


def with_titles(df: DataFrame, code: str, dst: str = "title") -> DataFrame:
    return df.withColumn(dst, title_of(F.col(code)))

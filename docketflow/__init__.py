"""docketflow: court-docket analytics as Spark DataFrame jobs.

Nested lawsuit records (header key/values, parties, movements, decisions)
are tidied into one typed row per lawsuit; party names are cleaned,
classified as person/company, folded into company labels and market
segments; saved docket pages are parsed into movement rows and stored
per day.  Every job is a ``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"

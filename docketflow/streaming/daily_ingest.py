"""Incremental daily ingest of saved docket pages (Structured Streaming).

One day is collected at a time, and a day may be collected again.  Page files
that land in a folder are picked up by a file-source stream and parsed by the
operators of the batch job; each micro-batch then

1. writes its parsed rows to a log, partitioned by day and batch id: a batch
   that is run again after a failure replaces what it wrote;
2. makes the days it touched anew from their log, newest fetch first, and
   replaces those days in the store, as the batch job does.

``fetch`` says which collection of the day a page belongs to.  Only the newest
fetch of a day counts, as a whole: a page that it no longer has is gone.  Pages
of one fetch may land in any number of batches; of one file within a fetch the
latest batch counts.  Making a day is a function of its log, so any step may be
repeated.

Counts of pages and errors are metrics of the stream (``page_status`` in its
progress) and of each batch; a batch with unreadable pages warns.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.movements import PARSED_SCHEMA, page_metrics, parse_pages, tidy_movements
from ..sources.store import write_daily

PAGES_SCHEMA = "file STRING, sg_date DATE, html STRING, fetch TIMESTAMP"
MOVEMENTS_SCHEMA = "file STRING, pos INT, movement DATE, title STRING, txt STRING, sg_date DATE"
LOG_SCHEMA = PARSED_SCHEMA + ", batch bigint"


def newest_fetch(log: DataFrame) -> DataFrame:
    """Log rows that count: of each day the newest fetch, of each of its files
    the latest batch."""
    # one time per day, found in a hash map; NULL if the day has no other
    days = log.groupBy("sg_date").agg(F.max("read").alias("_newest"))
    rows = log.join(days.withColumnRenamed("sg_date", "_day"), F.col("sg_date").eqNullSafe(F.col("_day"))).where(F.col("read").eqNullSafe(F.col("_newest")))
    last = rows.groupBy("sg_date", "file").agg(F.max("batch").alias("_last"))
    last = last.select(F.col("sg_date").alias("_d"), F.col("file").alias("_f"), "_last")
    on = F.col("sg_date").eqNullSafe(F.col("_d")) & F.col("file").eqNullSafe(F.col("_f")) & (F.col("batch") == F.col("_last"))
    return rows.join(last, on).drop("_day", "_newest", "_d", "_f", "_last")


def _replace_days(store_dir: str, log_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        rows = batch.observe(seen, *page_metrics()).withColumn("batch", F.lit(batch_id).cast("bigint"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
             .partitionBy("sg_date", "batch").parquet(log_dir))
        n = seen.get
        if n["n_error"]:
            warnings.warn(f"There were errors reading {n['n_error']} of {n['n_pages']} pages of batch {batch_id}.", stacklevel=1)
        if not n["n_pages"]:
            return
        log = spark.read.schema(LOG_SCHEMA).parquet(log_dir)
        days = [r[0] for r in log.where(F.col("batch") == batch_id).select("sg_date").distinct().collect()]
        touched = log.where(F.col("sg_date").isin([d for d in days if d is not None]) | (F.col("sg_date").isNull() if None in days else F.lit(False)))
        write_daily(tidy_movements(newest_fetch(touched)), store_dir, order_cols=["file", "pos"], days=[d for d in days if d is not None])
    return write


def start_ingest(spark: SparkSession, pages_dir: str, store_dir: str, checkpoint_dir: str,
                 available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """The running query.  The log is kept beside the checkpoint, which
    belongs to it."""
    src = (spark.readStream.schema(PAGES_SCHEMA)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(pages_dir))
    rows = parse_pages(src.withColumnRenamed("fetch", "read")).observe("page_status", *page_metrics())
    w = rows.writeStream.foreachBatch(_replace_days(store_dir, f"{checkpoint_dir}/log")).option("checkpointLocation", f"{checkpoint_dir}/query")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_once(spark: SparkSession, pages_dir: str, store_dir: str, checkpoint_dir: str,
             max_files_per_trigger: int = 1000) -> DataFrame:
    """Ingest everything available, wait for it, return the store."""
    q = start_ingest(spark, pages_dir, store_dir, checkpoint_dir, max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(MOVEMENTS_SCHEMA).parquet(store_dir)

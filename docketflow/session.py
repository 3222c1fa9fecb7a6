"""Session helpers: building a session for tests/bench and locating the
shared folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Conf every job relies on.  ANSI stays on (Spark 4 default): the code uses
# try_* functions where the reference yields NA instead of failing.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # pages are large: bound Arrow batches for the HTML parse by bytes too
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "docketflow", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in _BASE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "16g")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage and is only read.
    Only a local-mode session without the setting (tests) gets a fresh
    scratch folder of its own.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for this cluster")
        path = tempfile.mkdtemp(prefix="docketflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables)."""
    return os.path.join(ensure_checkpoint_dir(spark), "docketflow", *parts)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back: its
    lineage is cut, and Spark knows its size."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

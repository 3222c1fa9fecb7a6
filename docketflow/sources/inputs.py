"""The nested ``cases`` input for a data folder.

The reference's tidy job reads an already-nested file of parsed records;
here that file is derived once from the driver's tables (fixture SQL,
one aggregation) and written as Parquet under the shared checkpoint folder
(``spark.checkpoint.dir``).  Later jobs read it like any nested source:
nested column pruning and the status filter reach the scan.  Writing it
also cuts the fixture lineage, so a lost executor only recomputes
from the written files.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.cases import KEY, SOURCE_ROW, key_column, order_column, source_row
from ..session import scratch_path
from .fixtures import BASE_TABLES, FIXTURE_SQL, Fixtures, build_cases
from .store import write_bucketed, write_daily

CASES_SCHEMA = (
    "file STRING, return STRING, output STRUCT<id1: STRING, "
    "data: ARRAY<STRUCT<data: STRING, value: STRING>>, "
    "parts: ARRAY<STRUCT<name: STRING, part: STRING, role: STRING>>, "
    "movs: ARRAY<STRUCT<movement: DATE, title: STRING, txt: STRING>>, "
    "decisions: ARRAY<STRUCT<date: DATE, decision: STRING>>>")


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Changes with the place, length or time of any input file, as the
    store that holds them lists them, and with the fixture SQL."""
    h = hashlib.sha1()
    for n in BASE_TABLES:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir}/{n}.parquet")
                 .select("path", "length", "modificationTime").collect())
        for f in sorted(files):
            h.update(f"{n}:{f.path}:{f.length}:{f.modificationTime.timestamp()}".encode())
    for k in sorted(FIXTURE_SQL):
        h.update(FIXTURE_SQL[k].encode())
    return h.hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is there."""
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def cases_path(spark: SparkSession, sf_dir: str) -> str:
    return scratch_path(spark, "cases", _fingerprint(spark, sf_dir))


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """S1: read parsed case records (explicit schema, no inference), each with
    its place in the source."""
    return spark.read.schema(CASES_SCHEMA).parquet(path).select("*", source_row())


def cases_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested cases of ``sf_dir``: written once, then read.  A folder that
    another job has not finished is left alone: this one then reads a copy of
    its own."""
    path = cases_path(spark, sf_dir)
    if not _exists(spark, path):
        own = f"{path}-{uuid.uuid4().hex}"
        build = build_cases(Fixtures(spark, sf_dir)).write.option("compression", "zstd")
        try:
            build.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            build.parquet(own)
            return read_cases(spark, own)
    return read_cases(spark, path)


def write_case_days(cases: DataFrame, path: str, days: list | None = None) -> None:
    """S3: case records by day (``sg_date``), in the order of their source."""
    write_daily(cases, path, order_cols=["file", SOURCE_ROW], days=days)


def read_case_days(spark: SparkSession, path: str) -> DataFrame:
    """The stored case records of all days, each with its place in the store."""
    return spark.read.schema(CASES_SCHEMA + ", sg_date DATE").parquet(path).select("*", source_row())


def write_cases_by_key(cases: DataFrame, path: str, buckets: int, table: str | None = None) -> DataFrame:
    """Case records bucketed by their case key, each with the key and its
    place in the source.  All branches and joins of the tidy table, and any
    later run over the same table, then work without a shuffle of records."""
    rest = [c for c in cases.columns if c not in (KEY, SOURCE_ROW)]
    return write_bucketed(cases.select(*rest, order_column(cases), key_column(cases)), KEY, path, buckets, table)

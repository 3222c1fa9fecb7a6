"""The corpus pipeline: five operators over ``documents``, each stage's rows
written as Parquet and read again as the next one's documents.

What a stage drops grows with the documents, so it meets them by a shuffle at
every size and is never broadcast.

A stage gets (spark, docs, sf_dir).  All but the last return the columns of
``documents``; copies that the mix repeats are rows of their own.  Rows with
null ids, null texts, ties or repeats are treated as the operators' modules
state; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import scratch, stored
from docketflow.llm.decontaminate import phrase_matches
from docketflow.llm.langid import UNKNOWN, identify, train
from docketflow.llm.mixing import mix
from docketflow.llm.setsketch import near_duplicates
from docketflow.llm.tokens import token_output

#: Near copies share 80 % of their five-word shingles; 32 bands of 4 registers
#: miss 5e-8 of the pairs at that.
NEAR = {"threshold": 80, "band_rows": 4, "bands": 32}
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: those without text or a letter.  An
    ambiguous document stays.  A missing label is filled in."""
    rest = [c for c in COLUMNS if c != "text"]
    got = identify(docs, train(docs), rest, keep_text=True).where(F.col("lang_pred") != UNKNOWN)
    return got.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one of least id."""
    rows = stored(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")
    gone = near_duplicates(rows, "_row", **NEAR).where("rid <> keeper").select(F.col("rid").alias("_row")).hint("merge")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = phrase_matches(docs, benchmark).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct().hint("merge")
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_h"))
    return docs.select(*COLUMNS).join(hit, on, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows, _ = mix(docs.select(*COLUMNS), F.array(F.col("source").cast("string")))
    return rows.where("times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as files of packed ids, and a digest of each document's ids."""
    return token_output(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_output", token_ids),
]

#: The stages train a classifier and follow links to any depth.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest rows of the last stage, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

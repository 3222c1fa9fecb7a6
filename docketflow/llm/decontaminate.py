r"""Benchmark decontamination with a positional inverted index, in DataFrame
operations only.

The index stores (document, position, term) of every training token whose
term occurs in the benchmark; no other posting can take part in a match.  For
each window of a benchmark item the postings of its two rarest terms are
intersected after subtracting their offsets in the item, and what is left is
compared word by word with the document.  ``proximity_matches`` gives the
places where an item's two rarest terms stand near each other.

Defined cases: a null text has no words; an item without words has no
windows; items that repeat an id count once; an item without an id can hit
words but is not counted or listed; rows that repeat a ``doc_id`` are judged
each by its own text; of equally rare terms the first in the item is taken;
texts of any length are indexed whole; an empty benchmark leaves all documents
clean, an empty table of documents gives an empty result.  Only ``doc_id``, ``text``, ``item_id`` and the benchmark's ``text`` are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

WINDOW = 10
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOC = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    """Words as they are compared: A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), SEPARATOR), "")


def terms(text: Column) -> Column:
    """Words as they are indexed: wholly lower-cased, which is cheaper and
    maps equal words to equal terms at the same positions.  Lower-casing looks
    at what stands around a capital sigma, so that is replaced first; every
    other letter has one lower case wherever it stands."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3"))), SEPARATOR), "")


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item (a key of the row), item_id, words, terms, n."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("_t"))
    rows = rows.select("item_id", words(F.col("_t")).alias("words"), terms(F.col("_t")).alias("terms"))
    rows = rows.withColumn("n", F.size("words")).where("n > 0").withColumn("item", F.monotonically_increasing_id())
    return stored(rows, "decon-items")


def build_index(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, vocabulary): doc_id, text_hash, pos, term_id; and term,
    term_id, n_postings.

    The vocabulary is joined without a hint: Spark broadcasts the stored
    table if its size allows, else it shuffles, splitting hot terms.
    """
    vocabulary = stored(items.select(F.explode("terms").alias("term")).distinct()
                        .withColumn("term_id", F.monotonically_increasing_id()), "decon-terms")
    tokens = _docs(docs).select(*_DOC, F.posexplode(terms(F.col("text"))).alias("pos", "term"))
    postings = stored(tokens.join(vocabulary, "term").select(*_DOC, "pos", "term_id"), "decon-index")
    counts = postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("n_postings"))
    return postings, stored(vocabulary.join(counts, "term_id"), "decon-vocabulary")


def _rarest(items: DataFrame, vocabulary: DataFrame, window: int) -> DataFrame:
    """item, k, w, j1, t1, j2, t2: each window's first word and width, and its
    two rarest terms with their places in the item.  Windows with a term that
    no document has are left out."""
    w = F.least(F.lit(window), F.col("n"))
    at = items.select("item", w.alias("w"), F.explode(F.sequence(F.lit(0), F.col("n") - w)).alias("k"), "terms")
    at = at.select("item", "w", "k", F.posexplode(F.slice("terms", F.col("k") + 1, F.col("w"))).alias("j", "term"))
    at = at.join(vocabulary, "term").withColumn("j", F.col("j") + F.col("k"))
    order = F.sort_array(F.collect_list(F.struct("n_postings", "j", "term_id")))
    return (at.groupBy("item", "k", "w").agg(order.alias("o")).where(F.size("o") == F.col("w"))
            .select("item", "k", "w", F.col("o")[0]["j"].alias("j1"), F.col("o")[0]["term_id"].alias("t1"),
                    F.get("o", F.lit(1))["j"].alias("j2"), F.get("o", F.lit(1))["term_id"].alias("t2")))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, item_id, start, w: every place where a window of an
    item stands in a document."""
    items = item_windows(benchmark, window)
    postings, vocabulary = build_index(docs, items)
    rare = stored(_rarest(items, vocabulary, window), "decon-rarest")
    anchors = rare.select("item", F.col("j1").alias("j"), F.col("t1").alias("term_id")).union(
        rare.where("j2 IS NOT NULL").select("item", "j2", "t2")).distinct()
    # offset-adjusted postings: where the item would begin
    hits = postings.join(anchors, "term_id").withColumn("begin", F.col("pos") - F.col("j"))
    met = hits.groupBy(*_DOC, "item", "begin").agg(F.collect_set("j").alias("js"))
    plan = stored(rare.groupBy("item").agg(F.collect_list(F.struct("k", "w", "j1", "j2")).alias("windows")), "decon-plan")
    both = F.filter("windows", lambda x: F.array_contains("js", x["j1"])
                    & (x["j2"].isNull() | F.array_contains("js", F.coalesce(x["j2"], F.lit(-1)))))
    cand = met.join(plan, "item").select(*_DOC, "item", "begin", F.explode(both).alias("x"))
    cand = stored(cand.select(*_DOC, "item", (F.col("begin") + F.col("x.k")).alias("start"), F.col("x.k").alias("k"),
                              F.col("x.w").alias("w")).where("start >= 0"), "decon-candidates")
    # word by word, in the documents that have candidates; they grow with the
    # documents, so they meet by a shuffle at every size
    keys = cand.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).distinct().hint("merge")
    some = _docs(docs).join(keys, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left_semi")
    some = some.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), words(F.col("text")).alias("doc_words"))
    full = cand.join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
    full = full.join(some, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")))
    same = F.slice("doc_words", F.col("start") + 1, F.col("w")) == F.slice("item_words", F.col("k") + 1, F.col("w"))
    return full.where(same).select(*_DOC, "item_id", "start", "w")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, gap: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, item_id, pos_a, pos_b: places where an item's two
    rarest terms stand at most ``gap`` words apart.  Postings meet by blocks
    of positions, so no document's postings are paired with all others."""
    items = item_windows(benchmark)
    postings, vocabulary = build_index(docs, items)
    pairs = items.select("item", "item_id", F.explode(F.array_distinct("terms")).alias("term")).join(vocabulary, "term")
    rank = F.row_number().over(Window.partitionBy("item").orderBy("n_postings", "term"))
    pairs = pairs.withColumn("r", rank).where("r <= 2").groupBy("item", "item_id").agg(
        F.max(F.when(F.col("r") == 1, F.col("term_id"))).alias("a"), F.max(F.when(F.col("r") == 2, F.col("term_id"))).alias("b"))
    pairs = stored(pairs.where("b IS NOT NULL"), "decon-pairs")
    size = F.lit(gap + 1)
    left = postings.join(pairs, F.col("term_id") == F.col("a")).select(
        *_DOC, "item", "item_id", F.col("pos").alias("pos_a"), F.explode(F.array(*(F.floor(F.col("pos") / size) + i for i in (-1, 0, 1)))).alias("block"))
    right = postings.join(pairs, F.col("term_id") == F.col("b")).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("item").alias("_i"), F.col("pos").alias("pos_b"),
        F.floor(F.col("pos") / size).alias("_b"))
    on = (F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")) & (F.col("item") == F.col("_i"))
          & (F.col("block") == F.col("_b")) & (F.abs(F.col("pos_a") - F.col("pos_b")) <= gap))
    return left.join(right, on).select(*_DOC, "item_id", "pos_a", "pos_b")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, n_items,
    items_sha256, contaminated."""
    places = phrase_matches(docs, benchmark, window)
    places = places.select(*_DOC, "item_id", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("w") - 1)).alias("pos"))
    found = places.groupBy(*_DOC).agg(F.count_distinct("pos").alias("n_hit"), F.collect_set("item_id").alias("items"))
    found = found.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "n_hit", "items")
    all_ = _docs(docs).select(*_DOC, F.coalesce(F.size(terms(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    both = all_.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    items = F.sort_array(F.coalesce("items", F.array().cast("array<string>")))
    return both.select(*_DOC, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                       F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                       (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def op4_decontaminate(spark, sf_dir):
    """Benchmark hits of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_hash")


_SQL_WORDS = (r"list_filter(string_split_regex(translate(text, '" + string.ascii_uppercase + "', '" + string.ascii_lowercase
              + r"'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, least({WINDOW}, len(w)) AS n, w FROM b WHERE len(w) > 0),
k AS (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM i),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM k),
sizes AS (SELECT DISTINCT n FROM i),
p AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.s, p.n, windows.item_id FROM p JOIN windows
         ON windows.n = p.n AND windows.t = array_to_string(p.w[p.s:p.s + p.n - 1], ' ')),
places AS (SELECT doc_id, item_id, unnest(range(s, s + n)) AS pos FROM hits),
found AS (SELECT doc_id, count(DISTINCT pos) AS n_hit, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM places GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN found USING (doc_id)
"""

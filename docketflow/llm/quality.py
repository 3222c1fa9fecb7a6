"""Quality rules by host: rule failures are counted per domain, shrunk with
an empirical beta prior, and the host's verdict joined back to documents.

Defined cases: a null or empty text has no words and fails; a document
without a host is judged by its own rules alone; repeated rows each count;
a host whose rate is just the limit is kept; texts of any length are counted
whole; an empty table gives an empty result.  Only ``doc_id``, ``text`` and the
host column are read, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, mix, of_rows, span_hashes, spans, stored, text_slices, window_hashes

#: A host is rejected when its shrunk failure rate is above this.
HOST_LIMIT = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[0x0A] = True


def _sum_by(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=acc[1:])
    return acc[off[1:]] - acc[off[:-1]]


def _groups(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the hashes that occur more than once in a row: all but one member
    of each such group, and all members."""
    key = mix(h ^ mix(row.astype(np.uint64)))
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order[1:]] == key[order[:-1]]
    return order[same[:-1]], order[same[:-1] | same[1:]]


def _count(batches):
    for rows, data, off in text_slices(batches):
        n = rows.num_rows
        s, e, row = spans(data, off)
        in_word = ~SPACE[data] & ((data & 0xC0) != 0x80)
        h, at = window_hashes(span_hashes(data, s, e), row, 3)
        _, twice = _groups(h, row[at])
        covered = np.zeros(len(s), bool)
        for k in range(3):
            covered[at[twice] + k] = True
        # lines with a word: the runs between newlines that hold a word start
        ls, le, lrow = spans(data, off, _NEWLINE)
        has = np.searchsorted(s, le) > np.searchsorted(s, ls)
        ls, le, lrow = ls[has], le[has], lrow[has]
        again, _ = _groups(span_hashes(data, ls, le), lrow)
        count = lambda r: np.bincount(r, minlength=n).astype(np.int64)
        yield of_rows(rows, n_words=count(row), word_chars=_sum_by(in_word, off),
                      n_symbols=_sum_by(_SYMBOL[data], off), n_dup_lines=count(lrow[again]),
                      n_repeat_words=count(row[covered]))


def rule_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the five counts of the whole text, base_failed."""
    rows = docs.select("doc_id", F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    got = rows.mapInArrow(_count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, host string, {_COUNTS}")
    return got.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_rates(counts: DataFrame) -> DataFrame:
    """host, host_docs, host_failed and the shrunk rate.

    The beta prior's mean is the failure rate over all documents with a
    host; its weight (a + b) is fitted by moments to the spread of the hosts'
    rates.  Spread no wider than chance gives a prior that decides alone.
    """
    hosts = counts.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    total = hosts.agg(F.sum("host_docs").alias("n"), F.sum("host_failed").alias("f"), F.count(F.lit(1)).alias("k"),
                      F.sum(F.col("host_failed") * F.col("host_failed") / F.col("host_docs")).alias("q"))
    n, f, k, q = (total.first() or (None,) * 4)
    if not n:
        return hosts.withColumn("host_rate", F.lit(0.0))
    mean = f / n
    # weighted sum of squares of the rates about the mean, against that of chance
    spread, chance = q - n * mean * mean, mean * (1 - mean)
    squares = hosts.agg(F.sum(F.col("host_docs") * F.col("host_docs").cast("double"))).first()[0]
    between = (spread - (k - 1) * chance) / (n - squares / n) if k > 1 else 0.0
    if between <= 0:
        weight = float(n)  # the hosts don't differ: the prior holds
    else:
        weight = max(chance / between - 1, 0.0)
    return hosts.withColumn("host_rate", (F.col("host_failed") + weight * mean) / (F.col("host_docs") + weight))


def quality(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per document: counts, base_failed, its host's figures, kept.

    The counts, a few numbers a document, are stored, so each text is read
    once.  Rows are first summed per host inside each task, so a host with a
    third of all rows is no hot key; the join back is to one row a host.  No
    broadcast is forced: Spark broadcasts by size or splits a skewed join.
    """
    counts = stored(rule_counts(docs, host), "quality-counts")
    rates = host_rates(counts)
    both = counts.join(rates, "host", "left")
    ok = F.coalesce(F.col("host_rate") <= limit, F.lit(True))
    return both.withColumn("kept", ~F.col("base_failed") & ok)


def op3_quality(spark, sf_dir):
    """Counts and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                "base_failed", "kept")


_SPACE = r"[\x20\x09-\x0D]"

ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, CAST(source AS VARCHAR) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '{_SPACE}+'), lambda x: x <> '') AS w FROM d),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
p AS (SELECT r, s, w[s] || ' ' || w[s + 1] || ' ' || w[s + 2] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS s FROM w)),
twice AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY r, x) AS n FROM p) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT s + k) AS n FROM twice, range(3) AS t(k) GROUP BY r),
c AS (SELECT d.*, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c),
hosts AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS x FROM f WHERE host IS NOT NULL GROUP BY host),
total AS (SELECT sum(n) AS n, sum(x) AS x, count(*) AS k, sum(x * x / n) AS q, sum(n * n) AS nn FROM hosts),
prior AS (SELECT n, x / n AS m, x / n * (1 - x / n) AS chance,
                 CASE WHEN k > 1 THEN (q - x * x / n - (k - 1) * (x / n * (1 - x / n))) / (n - nn / n) ELSE 0 END AS between_ FROM total),
weight AS (SELECT m, CASE WHEN between_ <= 0 THEN n ELSE greatest(chance / between_ - 1, 0) END AS v FROM prior),
rates AS (SELECT host, (x + v * m) / (n + v) AS rate FROM hosts, weight)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(rate <= {HOST_LIMIT}, true) AS kept
FROM f LEFT JOIN rates USING (host)
"""

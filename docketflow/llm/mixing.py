"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they
belong to).  A small network routes each pattern's word capacity to the
sources' quotas; a pattern's second and third pass cost more than its first
(convex), so repetition is spread before it is deepened.  A source whose
documents belong to no other needs no network: its one pattern gives the quota,
in DataFrame operations, however many such sources there are.  Whole documents
are then selected by a seeded hash so that each pattern gives what was routed.

Defined cases: a null or empty text has size 0 and takes nothing; a null
source is a source of its own, sorted last; a null or empty list of sources
counts as the null source; documents are put in order by a hash of id and
text, rows that repeat both (null ids too) by a hash of their place in the
table, so that any number of them is split where the quota ends; an empty
table gives an empty result; texts of any length are counted whole.  Only
``doc_id``, ``text`` and the membership column are read.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
SEED = 17
#: Membership patterns of sources that overlap, which the driver routes.
#: Patterns are sets of sources, not documents; more of them is refused, never
#: cut.  Sources that overlap with none are not counted.
MAX_PATTERNS = 200_000
_CELL_BITS = 12


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: dict, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> dict:
    """Share of the total by weight (weights repeat over the sources in code
    point order, null last); a share above ``max_repeat`` times its source is
    cut to that and the excess shared again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), list(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > max_repeat * sizes[s]]
        for s in full or open_:
            out[s] = float(max_repeat * sizes[s]) if full else share[s]
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def _groups(patterns: dict) -> list[list]:
    """Patterns that share sources, directly or through others."""
    by_source = defaultdict(list)
    for p in patterns:
        for s in p:
            by_source[s].append(p)
    seen, out = set(), []
    for p in patterns:
        if p in seen:
            continue
        seen.add(p)
        queue, group = deque([p]), []
        while queue:
            x = queue.popleft()
            group.append(x)
            for s in x:
                for y in by_source.pop(s, ()):
                    if y not in seen:
                        seen.add(y)
                        queue.append(y)
        out.append(group)
    return out


def route(patterns: dict, quotas: dict, max_repeat: int = MAX_REPEAT) -> dict:
    """{(pattern, source): words} of least repetition cost among the largest
    flows.  Successive cheapest paths; pass number k of a pattern costs k."""
    flow: dict = defaultdict(int)
    for group in _groups(patterns):
        arcs: list[list] = []  # to, capacity left, cost
        out = defaultdict(list)

        def arc(a, b, cap, cost, arcs=arcs, out=out):
            for x, y, c, k in ((a, b, cap, cost), (b, a, 0, -cost)):
                out[x].append(len(arcs))
                arcs.append([y, c, k])

        for p in group:
            for k in range(max_repeat):
                arc("from", ("p", p), patterns[p], k + 1)
            for s in p:
                arc(("p", p), ("s", s), max_repeat * patterns[p], 0)
        for s in {s for p in group for s in p}:
            arc(("s", s), "to", quotas[s], 0)
        while True:
            cost, via, queue, queued = {"from": 0}, {}, deque(["from"]), {"from"}
            while queue:
                x = queue.popleft()
                queued.discard(x)
                for i in out[x]:
                    y, cap, k = arcs[i]
                    if cap > 0 and cost[x] + k < cost.get(y, float("inf")):
                        cost[y], via[y] = cost[x] + k, i
                        if y not in queued:
                            queue.append(y)
                            queued.add(y)
            if "to" not in via:
                break
            path, y = [], "to"
            while y != "from":
                path.append(via[y])
                y = arcs[via[y] ^ 1][0]
            most = min(arcs[i][1] for i in path)
            for i in path:
                arcs[i][1] -= most
                arcs[i ^ 1][1] += most
        for p in group:
            for i in out[("p", p)]:
                if i % 2 == 0:  # an arc to a source; its reverse holds the flow
                    flow[p, arcs[i][0][1]] += arcs[i ^ 1][1]
    return dict(flow)


def _crossing(cells: DataFrame, by: str) -> DataFrame:
    """Per pattern, the cell in which the running size passes what is left."""
    w = Window.partitionBy("pattern").orderBy(by)
    run = cells.withColumn("_after", F.sum("_size").over(w)).withColumn("_before", F.col("_after") - F.col("_size"))
    return run.where((F.col("_before") <= F.col("_left")) & (F.col("_after") > F.col("_left")))


def _passed(rows: DataFrame, by: str) -> DataFrame:
    """pattern, the value of ``by`` at which the running size of the rows in
    its order passes ``_left``, what is left there and the group's rows
    (``_n``).  Two histograms of 4,096 cells per pattern find the cell that is
    crossed (rows are summed inside each task first, so a pattern with a third
    of all rows is no hot key); only the groups of that cell are put in
    order."""
    base = rows.drop("_left")
    for step in range(2):
        shift = 63 - _CELL_BITS * (step + 1)
        cells = rows.withColumn("_cell", F.shiftright(by, shift)).groupBy("pattern", "_cell").agg(
            F.sum("size").alias("_size"), F.first("_left").alias("_left"))
        found = stored(_crossing(cells, "_cell").select(
            "pattern", F.col("_cell"), (F.col("_left") - F.col("_before")).alias("_left")), "mix-cells")
        rows = base.join(found, "pattern").where(F.shiftright(by, shift) == F.col("_cell")).drop("_cell")
    groups = rows.groupBy("pattern", by).agg(F.sum("size").alias("_size"), F.first("_left").alias("_left"), F.count(F.lit(1)).alias("_n"))
    return stored(_crossing(groups, by).select("pattern", by, "_n", (F.col("_left") - F.col("_before")).alias("_left"),
                                               (F.col("_after") - F.col("_left")).alias("_over")), "mix-passed")


def select_by_hash(sized: DataFrame, extra: DataFrame) -> DataFrame:
    """pattern, _until, _last: the rows with ``h`` below ``_until``, or at it
    and with ``row`` up to ``_last`` (any if null), have about ``extra``
    words."""
    sized = sized.where("size > 0").select("pattern", "h", "row", "size")
    first = _passed(sized.join(extra, "pattern"), "h")
    near = F.col("_over") < F.col("_left")
    alone = first.where("_n = 1").select("pattern", F.when(near, F.col("h")).otherwise(F.col("h") - 1).alias("_until"), F.lit(None).cast("long").alias("_last"))
    tied = first.where("_n > 1").select("pattern", "h", "_left")
    second = _passed(sized.join(tied, ["pattern", "h"]).drop("h"), "row")
    second = second.select("pattern", F.when(near, F.col("row")).otherwise(F.col("row") - 1).alias("_last"))
    return alone.unionByName(tied.join(second, "pattern").select("pattern", F.col("h").alias("_until"), "_last"))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of the row that any later scan finds again: its
    place in its file, else in a stored copy."""
    at = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "_metadata.file_path", "_metadata.row_index"), 1)
    try:
        return docs.withColumn("row", at)
    except AnalysisException:
        return stored(docs, "mix-rows").withColumn("row", at)


def _sized(docs: DataFrame, sources: Column, seed: int) -> DataFrame:
    member = F.coalesce(sources, F.array(F.lit(None).cast("string")))
    member = F.when(F.size(member) == 0, F.array(F.lit(None).cast("string"))).otherwise(member)
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text").cast("string")), 1)
    return docs.withColumns({"pattern": F.to_json(F.sort_array(F.array_distinct(member))), "h": h,
                             "size": word_count(F.col("text").cast("string"))})


def target_table(patterns: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target of all sources of ``patterns`` (pattern,
    size), as ``targets`` has them.  A share is weight times one level for all;
    the level rises as sources reach their limit, by a count of the sources
    each time."""
    source = F.explode(F.from_json("pattern", "array<string>")).alias("source")
    sizes = patterns.select(source, "size").groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # of sources, not documents
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    sizes = stored(sizes.withColumn("weight", weight), "mix-sources")
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    limit, level, full = max_repeat * F.col("source_size"), 0.0, -1
    while True:
        open_ = limit >= F.col("weight") * level
        got = sizes.agg(F.sum(F.when(open_, F.col("weight"))).alias("w"), F.sum(F.when(~open_, limit)).alias("f"),
                        F.count_if(~open_).alias("n")).first()
        if got["n"] == full or not got["w"]:
            break
        full, level = got["n"], (total - (got["f"] or 0)) / got["w"]
    share = F.col("weight") * level
    return sizes.select("source", "source_size", F.when(limit < share, limit.cast("double")).otherwise(share).alias("target"))


def mix_plan(sized: DataFrame, max_repeat: int = MAX_REPEAT, weights=WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """From stored rows (pattern, h, row, size): the plan, a row per pattern,
    and the figures, a row per source (source, source_size, target)."""
    spark = sized.sparkSession
    patterns = stored(sized.groupBy("pattern").agg(F.sum("size").alias("size")), "mix-patterns")
    figures = stored(target_table(patterns, weights, max_repeat), "mix-figures")
    member = patterns.select("pattern", "size", F.from_json("pattern", "array<string>").alias("of"))
    shared = member.select("pattern", F.explode("of").alias("source")).groupBy("source").agg(
        F.count(F.lit(1)).alias("_k"), F.max("pattern").alias("pattern")).withColumn("alone", F.col("_k") == 1)
    known = member.join(shared.where("alone").select("pattern", F.col("source").alias("_s")).join(
        figures.select(F.col("source").alias("_f"), "target"), F.col("_s").eqNullSafe(F.col("_f"))), "pattern", "left")
    lone = (F.size("of") == 1) & F.col("target").isNotNull()
    known = stored(known.withColumn("lone", F.coalesce(lone, F.lit(False))), "mix-known")

    # the network of overlapping sources
    found = known.where("NOT lone").select("pattern", "size").distinct().limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns of overlapping sources")
    overlapping = {tuple(json.loads(r.pattern)): r["size"] for r in found}
    names = known.where("NOT lone").select(F.explode("of").alias("source")).distinct()
    quotas = {r["source"]: round(r["target"]) for r in figures.join(names.withColumnRenamed("source", "_n"), F.col("source").eqNullSafe(F.col("_n"))).collect()} \
        if overlapping else {}
    given: dict = defaultdict(int)
    for (p, _), flow in route(overlapping, quotas, max_repeat).items():
        given[p] += flow
    key = {tuple(json.loads(r.pattern)): r.pattern for r in found}
    routed = spark.createDataFrame([(key[p], n, given[p]) for p, n in overlapping.items()], "pattern string, size long, given long")

    straight = known.where("lone").select("pattern", "size", F.least(F.round("target").cast("long"), max_repeat * F.col("size")).alias("given"))
    plan = straight.unionByName(routed)
    plan = stored(plan.select("pattern", F.when(F.col("size") > 0, F.floor(F.col("given") / F.col("size"))).otherwise(0).cast("long").alias("_full"),
                              F.when(F.col("size") > 0, F.col("given") % F.col("size")).otherwise(0).cast("long").alias("_left")), "mix-plan")
    until = select_by_hash(sized, plan.where("_left > 0").select("pattern", "_left"))
    return stored(plan.join(until, "pattern", "left").select("pattern", "_full", "_until", "_last"), "mix-plan"), figures


def mix(docs: DataFrame, sources: Column, max_repeat: int = MAX_REPEAT, weights=WEIGHTS, seed: int = SEED, columns: list[str] | None = None):
    """(rows, figures): the rows of ``docs`` with pattern, size, times and
    taken; figures are per source: source, source_size, target.  With
    ``columns`` the rows have those only, and the texts are read once."""
    rows = _sized(_numbered(docs), sources, seed)
    sized = stored(rows.select(*(columns or []), "pattern", "h", "row", "size"), "mix-sizes")
    plan, figures = mix_plan(sized, max_repeat, weights)
    rows = (rows if columns is None else sized).join(plan, "pattern")
    at = (F.col("h") < F.col("_until")) | (F.col("h") == F.col("_until")) & (F.col("_last").isNull() | (F.col("row") <= F.col("_last")))
    times = F.col("_full") + F.coalesce(at.cast("long"), F.lit(0))
    return rows.withColumn("times", times).withColumn("taken", F.col("times") * F.col("size")).drop("_full", "_until", "_last", "h", "row"), figures


def op8_mixing(spark, sf_dir):
    """The mix of all documents over their sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    rows, figures = mix(docs, F.array(F.col("source").cast("string")), columns=["doc_id"])
    figures = figures.withColumn("pattern", F.to_json(F.array("source")))
    return rows.join(figures, "pattern").select("doc_id", "size", "source_size", "target", "taken")

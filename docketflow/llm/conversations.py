"""Conversation repair: the cheapest edits that give every conversation the
roles ``(s?(ua)+)?``, by initials.

Edits: Keep (0), Rerole to the role that must come next (2), Delete (3; a must
for blank and duplicate rows), Insert an empty turn of that role (2); a
truncated row that stays adds 1.  Four states say which role must come next,
so an audit (the initials of the edits) tells everything that is done.

The cost of finishing from each state is computed from the last row back.
Vectors of these costs are kept at every ``sqrt(n)``-th row only; the walk
forward, which takes the ASCII-least edit that is still on a cheapest path
(greedy, hence the least audit of all), computes those of one block again from
the checkpoint behind it.  So a conversation of n rows needs its n row codes
(a byte each), the audit and about ``2 sqrt(n)`` vectors.

Two shuffles.  The first moves codes and hashes, no texts, and gives the
audits.  The second sends each conversation's audit ahead of its rows, which
then pass through in order and are edited one by one: a conversation of any
length is streamed, never held.  A digest over all texts of a conversation
is sequential by nature, so its rows do pass through one task.

Defined cases: null roles, texts, ids and turns count as one space (a null id
is one conversation, null turns come first and don't count in gaps); rows of
one turn are in the order of role, first characters and hash of the text, and
equal rows are interchangeable; a repeated row is a duplicate; a role with
another initial, or none, is rerolled or deleted; a conversation that lost all
rows has an empty audit; an empty table gives an empty table.  Only
``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a.  The role that comes next
#: and the state after it.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
ACCEPT = (0, 3)
_INF = 1 << 60
#: Row codes: fault * 4 + initial.
_INITIALS = "sua"
OTHER = 3
FINE, TRUNCATED, DELETED, GONE = 0, 1, 2, 3
_WORD = r"[^\x20\x09-\x0D]"
_SORT = ["turn", "role", "lead", "h1", "h2"]


def _kept(state: int, initial: int) -> int:
    """State after a kept row of this initial, or -1."""
    if initial == 0:
        return 1 if state == 0 else -1
    if initial == 1:
        return 2 if state != 2 else -1
    return 3 if initial == 2 and state == 2 else -1


_KEPT = [[_kept(s, i) for i in range(4)] for s in range(4)]


def _inserted(v: list[int]) -> tuple[int, ...]:
    """Costs when roles may be inserted first; two in a row at most help."""
    for _ in range(2):
        v = [min(v[s], INSERT + v[NEXT[s]]) for s in range(4)]
    return tuple(v)


def _end() -> tuple[int, ...]:
    return _inserted([0 if s in ACCEPT else _INF for s in range(4)])


def _without_insert(code: int, after, s: int):
    """(edit, cost, state) of the edits that use the row, ASCII-least first."""
    fault, initial = divmod(code, 4)
    yield "D", DELETE + after[s], s
    if fault != DELETED:
        more = CUT if fault == TRUNCATED else 0
        to = _KEPT[s][initial]
        if to >= 0:
            yield "K", more + after[to], to
        yield "R", REROLE + more + after[NEXT[s]], NEXT[s]


_memo: dict = {}


def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from before a row, given those after it.  Vectors repeat up to a
    constant, so each different one is computed once."""
    low = min(after)
    key = code, tuple(x - low for x in after)
    got = _memo.get(key)
    if got is None:
        got = _inserted([min(c for _, c, _ in _without_insert(code, key[1], s)) for s in range(4)])
        if len(_memo) < 10_000:
            _memo[key] = got
    return tuple(x + low for x in got)


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of rows with these codes."""
    n = len(codes)
    step = isqrt(n) + 1
    marks = {n: _end()}
    v = marks[n]
    for i in range(n - 1, -1, -1):
        v = _before(codes[i], v)
        if i % step == 0:
            marks[i] = v
    cost, state, audit = v[0], 0, []
    for a in range(0, n, step):
        b = min(a + step, n)
        block = [marks[b]]
        for i in range(b - 1, a - 1, -1):
            block.append(_before(codes[i], block[-1]))
        block.reverse()
        for i in range(a, b):
            used = False
            while not used:
                left = block[i - a][state]
                edits = {e: (c, to) for e, c, to in _without_insert(codes[i], block[i - a + 1], state)}
                if edits["D"][0] == left:
                    audit.append("D")
                    used = True
                elif INSERT + block[i - a][NEXT[state]] == left:
                    audit.append("I")
                    state = NEXT[state]
                else:
                    e = "K" if edits.get("K", (_INF, 0))[0] == left else "R"
                    audit.append(e)
                    state, used = edits[e][1], True
    while state not in ACCEPT:
        audit.append("I")
        state = NEXT[state]
    return cost, "".join(audit)


def damaged(rows: DataFrame) -> DataFrame:
    """The fixed damage by crc32 of ``conv_id:turn``: conv_id, turn, role,
    text and gone (the row is dropped; kept here so that its conversation is
    known)."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    out = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("_k"))
    out = out.select(
        "conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_k") == 0).alias("gone"), F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    return out.drop("_copy")


def _keyed(rows: DataFrame) -> DataFrame:
    rows = rows if "gone" in rows.columns else rows.withColumn("gone", F.lit(False))
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"),
                       F.coalesce(F.col("text").cast("string"), space).alias("text"), "gone")
    return rows.withColumns({"lead": F.substring("text", 1, 32), "h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")})


def _ends(batches, columns):
    """Runs of equal conv_id in sorted batches: (id, first?, batch piece)."""
    last, any_ = None, False
    for b in batches:
        ids = b.column("conv_id").to_pylist()
        i = 0
        while i < len(ids):
            j = i + 1
            while j < len(ids) and ids[j] == ids[i]:
                j += 1
            yield ids[i], not any_ or ids[i] != last, [b.column(c).slice(i, j - i).to_pylist() for c in columns]
            last, any_ = ids[i], True
            i = j


class _Tally:
    """What the first pass keeps of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.counts = conv_id, bytearray(), [0, 0, 0]
        self.illegal, self.before, self.turns, self.low, self.high = 0, None, 0, None, None

    def add(self, turns, fault, initial):
        for t, f, i in zip(turns, fault, initial, strict=True):
            if f < 0:
                continue
            if t is not None and t != self.high:
                self.turns += 1
                self.low, self.high = (t if self.low is None else self.low), t
            if f:
                self.counts[f - 1] += 1
            self.illegal += self.before is not None and (self.before, i) not in ((0, 1), (1, 2), (2, 1))
            self.before = i
            self.codes.append((DELETED if f in (1, 2) else TRUNCATED if f == 3 else FINE) * 4 + i)

    def row(self):
        cost, audit = cheapest(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts, self.illegal, cost, audit)


_AUDIT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _auditor(kind):
    schema = pa.schema([("conv_id", kind), *((c, pa.int64()) for c in _AUDIT[:-1]), ("audit", pa.string())])

    def audit(batches):
        now, out, held = None, [], 0
        for conv, first, (turn, fault, initial) in _ends(batches, ["turn", "fault", "initial"]):
            if first:
                if now is not None:
                    out.append(now.row())
                    held += len(out[-1][-1])
                if len(out) >= 4096 or held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out, held = [], 0
                now = _Tally(conv)
            now.add(turn, fault, initial)
        if now is not None:
            out.append(now.row())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    return audit


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, illegal neighbours, gaps,
    cost and audit.  Rows with ``gone`` only name their conversation."""
    keyed = _keyed(rows)
    kind, arrow = keyed.schema["conv_id"].dataType.simpleString(), _arrow(keyed, "conv_id")
    initial = F.substring("role", 1, 1)
    code = F.coalesce(*(F.when(initial == c, k) for k, c in enumerate(_INITIALS)), F.lit(OTHER))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "h1", "h2", "gone").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(F.col("gone"), -1).when(~F.col("text").rlike(_WORD), 1).when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 3).otherwise(0)
    light = keyed.select("conv_id", *_SORT, "gone", fault.alias("fault"), code.cast("int").alias("initial")).withColumn("_n", seen)
    light = light.withColumn("fault", F.when((F.col("_n") > 1) & F.col("fault").isin(0, 3), 2).otherwise(F.col("fault")))
    light = light.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), *_SORT[1:], "_n")
    return light.select("conv_id", F.col("turn").cast("long").alias("turn"), "fault", "initial").mapInArrow(
        _auditor(arrow), f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _AUDIT[:-1]) + ", audit string")


def _arrow(df: DataFrame, column: str):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)


def _turns(batches):
    """(conv_id, audit row or None, edit, role, text): first each
    conversation's audit row, then its repaired turns in order."""
    audit, at, state = "", 0, 0

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role, state = NEXT_ROLE[state], NEXT[state]
            at += 1
            yield "I", role, ""
    conv = None
    for conv_id, first, columns in _ends(batches, [*_AUDIT, "role", "text", "head"]):
        for *figures, head, in zip(*columns, strict=True):
            *figures, role, text = figures
            if head:
                if not first:
                    raise ValueError("two audits of one conversation")
                for x in inserted():
                    yield conv, None, *x
                conv, audit, at, state, first = conv_id, figures[-1], 0, 0, False
                yield conv, figures, "", "", ""
                continue
            for x in inserted():
                yield conv, None, *x
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            if edit == "R":
                role, state = NEXT_ROLE[state], NEXT[state]
            else:
                state = _KEPT[state][_INITIALS.find(role[:1])]
            yield conv, None, edit, role, text
    for x in inserted():
        yield conv, None, *x


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Audits ahead of their conversations' rows, sorted."""
    keyed = _keyed(rows).where(~F.col("gone"))
    body = keyed.select("conv_id", *_SORT, "text", F.lit(0).alias("head"), *(F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in _AUDIT))
    heads = found.select("conv_id", *(F.lit(None).cast(keyed.schema[c].dataType).alias(c) for c in _SORT), F.lit(None).cast("string").alias("text"),
                         F.lit(1).alias("head"), *_AUDIT)
    both = body.unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.col("head").desc(), F.col("turn").asc_nulls_first(), *_SORT[1:]).select("conv_id", *_AUDIT, "role", "text", "head")


def _batched(rows, schema, weight):
    out, held = [], 0
    for r in rows:
        out.append(r)
        held += weight(r)
        if held > 1 << 20 or len(out) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, seq, role, text, edit."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", _arrow(rows, "conv_id")), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])

    def turns(batches):
        def each():
            seq = 0
            for conv, head, edit, role, text in _turns(batches):
                seq = 0 if head else seq + 1
                if not head:
                    yield conv, seq - 1, role, text, edit
        yield from _batched(each(), schema, lambda r: len(r[3]))
    return _stream(rows, found).mapInArrow(turns, f"conv_id {kind}, seq long, role string, text string, edit string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The audits with the SHA-256 of the repaired ``role:text`` lines."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", _arrow(rows, "conv_id")), *((c, pa.int64()) for c in _AUDIT[:-1]), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def hashed(batches):
        def each():
            now = None
            for conv, head, _, role, text in _turns(batches):
                if head:
                    if now is not None:
                        yield *now, sha.hexdigest()
                    now, sha, start = (conv, *head), hashlib.sha256(), b""
                else:
                    sha.update(start + f"{role}:{text}".encode())
                    start = b"\n"
            if now is not None:
                yield *now, sha.hexdigest()
        yield from _batched(each(), schema, lambda r: len(r[-2]))
    return _stream(rows, found).mapInArrow(hashed, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in _AUDIT[:-1]) + ", audit string, repaired_sha256 string")


def op13_repair(spark, sf_dir):
    """Faults, cheapest repair and digest of every conversation."""
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return digests(rows, audits(rows))

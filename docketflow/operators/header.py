"""Header branch: key/value rows of each case to 17 typed columns.

1. explode ``output.data`` with positions and clean the keys;
2. drop keys seen once in the WHOLE table: a count per key with the least
   hash of a case key (partial aggregation).  A key seen once belongs to that one
   case, so it comes back by case key, the partitioning that step 3 needs anyway;
   no header row is ever shuffled by its key;
3. ONE shuffle of one row per record, whose header is an array: for each of
   the eight used keys, the distinct values of the case's records in
   first-seen order joined by ``@`` (this is the pivot);
4. row-wise expressions for the derived columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import COMARCA_FIXES
from ..functions.text import (clean_key, clean_place, pad2, parse_real, split_get)
from ..session import stored
from .cases import (KEY, carried, in_order, key_column, ok_cases, order_column, per_case, unnest_child, without_key)

# --- fixed values -----------------------------------------------------------
# Header keys used downstream, as cleaned (squished, unaccented, lower).
HEADER_KEYS = ["distribuicao", "area", "origem", "assunto", "valor da acao",
               "classe", "relator", "situacao"]
# Chamber kind: first matching test wins (case-sensitive).
CHAMBER_KIND_RULES = [
    ("Criminal", "Criminal"),
    ("Privado", "Privado"),
    ("Empresarial", "Empresarial"),
    ("P[uú]blico", "Público"),
    ("Ambien", "Ambiental"),
    ("Recup", "Falência e Recuperação"),
]
CHAMBER_EXTRAORDINARY = "Extraordin"
CHAMBER_ORDINARY = "ª Câmara (Reservada )?de.*[^A-Z]$"
# Private-law chamber numbers (two-digit strings) per family.
FAMILY_CHAMBERS = [f"{i:02d}" for i in range(1, 11)]
CONTRACT_CHAMBERS = [f"{i:02d}" for i in list(range(11, 25)) + [37, 38]]
PROPERTY_CHAMBERS = [f"{i:02d}" for i in range(25, 37)]
COMARCA_AFTER = "(?<=Comarca de ).*"
ORIGIN_SEP = " / "
SUBJECT_SEP = " ?- ?"
# ----------------------------------------------------------------------------


def column_name(key: str) -> str:
    """Snake-case column name of a cleaned key."""
    return key.replace(" ", "_")


def header_long(cases: DataFrame) -> DataFrame:
    """``id1, file, pos, data, value`` with cleaned keys (cleaned per row)."""
    x = unnest_child(cases, "data", ["data", "value"], with_source_row=True)
    return x.select("id1", "file", *carried(x), "src_row", "pos", clean_key("data").alias("data"), "value")


def raw_key_counts(cases: DataFrame) -> DataFrame:
    """``raw, data, n``: rows per raw key spelling with its cleaned key.
    Grouping raw spellings first (partial aggregation collapses them
    map-side) means the cleaning runs once per distinct spelling."""
    raw = unnest_child(cases, "data", ["data"])
    per_raw = raw.groupBy(F.col("data").alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    return per_raw.select("raw", clean_key("raw").alias("data"), "n")


def key_totals(cases: DataFrame) -> DataFrame:
    """``data, n``: rows per cleaned key of the whole table."""
    return raw_key_counts(cases).groupBy("data").agg(F.sum("n").cast("bigint").alias("n"))


def kept_keys_of(cases: DataFrame) -> DataFrame:
    """Keys seen more than once in the whole table, with their count."""
    return key_totals(cases).filter(F.col("n") > 1)


def keys_once(cases: DataFrame) -> DataFrame:
    """``h, rare``: the cleaned keys seen once in the whole table, by the hash
    of the case key they stand in.

    Raw spellings are counted with the least hash beside the count, which is the
    only one where the count is 1.  Both are numbers, so header rows are counted
    in a hash map and never sorted."""
    hashed = ok_cases(cases).select(F.xxhash64(key_column(cases)).alias("h"), F.col("output.data.data").alias("_k"))
    per_raw = hashed.select("h", F.explode("_k").alias("data")).groupBy("data").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("h"))
    cleaned = per_raw.select(clean_key("data").alias("data"), "n", "h")
    once = cleaned.groupBy("data").agg(F.sum("n").alias("n"), F.min("h").alias("h")).where(F.col("n") == 1)
    return once.groupBy("h").agg(F.collect_list(F.struct("data")).alias("rare"))


def rare_by_case(cases: DataFrame) -> DataFrame:
    """``case_key, n_rare, rare``: the cases that hold keys seen once in the
    whole table, and those keys (as structs, since a key may be NULL), as a
    written table.  A second read takes the records whose case key has a hash of
    :func:`keys_once`; only those that hold the key count, so another case of
    the same hash does not."""
    keys = stored(keys_once(cases), "keys-once")
    records = ok_cases(cases).select(key_column(cases), F.col("output.data.data").alias("_k")).withColumn("h", F.xxhash64(KEY))
    held = records.join(keys, "h").select(KEY, "rare", F.transform("_k", clean_key).alias("_k"))
    held = held.select(KEY, F.filter("rare", lambda r: F.exists("_k", lambda k: k.eqNullSafe(r["data"]))).alias("rare"))
    by_case = held.where(F.size("rare") > 0).groupBy(KEY).agg(F.sum(F.size("rare")).alias("n_rare"), F.flatten(F.collect_list("rare")).alias("rare"))
    return stored(by_case, "rare-by-case")


def is_rare(key: Column, rare: Column) -> Column:
    """Whether a cleaned key is among a case's ``rare`` ones."""
    return F.coalesce(F.exists(rare, lambda r: r["data"].eqNullSafe(key)), F.lit(False))


def _records(cases: DataFrame, **arrays) -> DataFrame:
    """Per record: case key, source order, header rows, and ``arrays`` of its
    header with cleaned keys (``data, pos, value``)."""
    cleaned = F.transform("output.data", lambda x, i: F.struct(
        clean_key(x["data"]).alias("data"), i.alias("pos"), x["value"].alias("value")))
    rows = ok_cases(cases).where(F.size("output.data") > 0).select(
        key_column(cases), order_column(cases), F.size("output.data").alias("n_head"), cleaned.alias("_h"))
    return rows.select(KEY, "src_row", "n_head", *[f(F.col("_h")).alias(n) for n, f in arrays.items()])


def _cases_kept(rows: DataFrame, cases: DataFrame) -> DataFrame:
    """``case_key, rare`` and the records' arrays of the cases with a header row
    whose key is seen more than once."""
    both = per_case(rows, cases, "n_head").join(rare_by_case(cases), KEY, "left")
    return both.where(F.col("n_head") > F.coalesce("n_rare", F.lit(0))).drop("n_head", "n_rare")


def _joined_values(values: Column) -> Column:
    """Distinct values (first-seen order, NULL kept once) joined by ``@``;
    NULL prints as ``NA``; no row gives NULL."""
    vals = F.array_distinct(values)
    return F.when(F.size(vals) > 0, F.array_join(vals, "@", "NA"))


def header_values(cases: DataFrame) -> DataFrame:
    """One joined value per (case, kept key)."""
    def by_key(h):
        keys = F.array_distinct(F.transform(h, lambda x: F.struct(x["data"].alias("data"))))
        return F.transform(keys, lambda k: F.struct(k["data"].alias("data"), F.filter(
            h, lambda x: x["data"].eqNullSafe(k["data"])).alias("rows")))

    kept = _cases_kept(_records(cases, keys=by_key), cases)
    # a case of many records keeps one list of each key's rows
    each = kept.select(KEY, "rare", F.explode("keys").alias("x")).select(KEY, "rare", "x.src_row", F.explode("x.keys").alias("k"))
    each = each.where(~is_rare(F.col("k.data"), F.col("rare"))).select(KEY, "k.data", F.struct("src_row", "k.rows").alias("x"))
    one = each.groupBy(KEY, "data").agg(F.collect_list("x").alias("r"))
    return without_key(one.select(KEY, "data", _joined_values(in_order(F.col("r"), "rows", "value")).alias("value")))


def keyed_wide(cases: DataFrame) -> DataFrame:
    # a row of an unused key only shows that the case has a header row: its
    # value stays behind
    def rows_of(key):
        return lambda h: F.transform(F.filter(h, lambda x: x["data"] == key), lambda x: F.struct(
            x["pos"].alias("pos"), x["value"].alias("value")))

    kept = _cases_kept(_records(cases, **{column_name(k): rows_of(k) for k in HEADER_KEYS}), cases)
    names = {column_name(k): k for k in HEADER_KEYS}
    values = kept.select(KEY, "rare", *[in_order(F.col(c), c, "value").alias(c) for c in names])
    return values.select(KEY, *[F.when(~is_rare(F.lit(k), F.col("rare")), _joined_values(F.col(c))).alias(c) for c, k in names.items()])


def header_wide(cases: DataFrame) -> DataFrame:
    """``n_processo, file`` + one column per used key (NULL if absent)."""
    return without_key(keyed_wide(cases))


# --- derived columns (row-wise) ---------------------------------------------

def chamber_number(dist: Column) -> Column:
    return pad2(F.regexp_substr(dist, F.lit("[0-9]+")))


def chamber_kind(dist: Column) -> Column:
    expr = None
    for pattern, label in CHAMBER_KIND_RULES:
        cond = dist.rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def chamber_regime(dist: Column) -> Column:
    return (F.when(dist.rlike(CHAMBER_EXTRAORDINARY), "Extraordinária")
            .when(dist.rlike(CHAMBER_ORDINARY), "Ordinária")
            .otherwise("Outro"))


def area_family(area: Column, chamber: Column) -> Column:
    broad = F.when(area.isNull(), F.lit(None)).when(area == "Criminal", "Criminal").otherwise("Privado")
    private = broad == "Privado"
    return (F.when(private & chamber.isin(FAMILY_CHAMBERS), "Família")
            .when(private & chamber.isin(CONTRACT_CHAMBERS), "Contratos")
            .when(private & chamber.isin(PROPERTY_CHAMBERS), "Imobiliário")
            .when(broad == "Criminal", "Criminal"))


def comarca(origin: Column) -> Column:
    piece = split_get(origin, ORIGIN_SEP, 3, 0)
    after = F.when(piece.rlike(COMARCA_AFTER), F.regexp_extract(piece, COMARCA_AFTER, 0))
    cleaned = clean_place(after)
    fixes = F.create_map(*[F.lit(x) for pair in COMARCA_FIXES for x in pair])
    return F.coalesce(F.try_element_at(fixes, cleaned), cleaned)


def foro(origin: Column) -> Column:
    return split_get(origin, ORIGIN_SEP, 3, 1)


def subject_parent(subject: Column) -> Column:
    return split_get(subject, SUBJECT_SEP, 2, 0)


def subject_child(subject: Column) -> Column:
    return split_get(subject, SUBJECT_SEP, 2, 1)


def old_currency(value: Column) -> Column:
    return value.rlike("[cC]")


HEADER_COLUMNS = ["n_processo", "file", "info_area", "info_classe", "info_assunto_full",
                  "info_assunto_pai", "info_assunto_filho", "info_camara_nm",
                  "info_camara_num", "info_camara_tipo", "info_camara_regime",
                  "info_relator", "info_comarca", "info_foro", "info_status",
                  "info_cruzeiro", "info_valor"]


def header_columns() -> list[Column]:
    """The header columns beside the key, as expressions over a wide row."""
    c = F.col
    dist = c("distribuicao")
    chamber = chamber_number(dist)
    return [
        area_family(c("area"), chamber).alias("info_area"),
        c("classe").alias("info_classe"),
        c("assunto").alias("info_assunto_full"),
        subject_parent(c("assunto")).alias("info_assunto_pai"),
        subject_child(c("assunto")).alias("info_assunto_filho"),
        dist.alias("info_camara_nm"),
        chamber.alias("info_camara_num"),
        chamber_kind(dist).alias("info_camara_tipo"),
        chamber_regime(dist).alias("info_camara_regime"),
        c("relator").alias("info_relator"),
        comarca(c("origem")).alias("info_comarca"),
        foro(c("origem")).alias("info_foro"),
        c("situacao").alias("info_status"),
        old_currency(c("valor_da_acao")).alias("info_cruzeiro"),
        parse_real(c("valor_da_acao")).alias("info_valor")]


def keyed_header(cases: DataFrame) -> DataFrame:
    return keyed_wide(cases).select(KEY, *header_columns())


def header_table(cases: DataFrame) -> DataFrame:
    return without_key(keyed_header(cases))

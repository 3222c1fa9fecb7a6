"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (through the nested ``cases`` input
derived from them) over the whole data; nothing is sampled or capped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import display_from_fixed, fix_names, is_legal_person, legal_person_from
from ..functions.text import unaccent
from ..operators import cases as C
from ..operators import companies as CO
from ..operators import decisions as DE
from ..operators import durations as MO
from ..operators import header as H
from ..operators import parties as PA
from ..operators import profile as PR
from ..operators import movements as MV
from ..operators import search as SE
from ..session import scratch_path, stored
from ..sources.fixtures import Fixtures
from ..sources.inputs import _fingerprint, cases_for, read_case_days, write_case_days, write_cases_by_key
from ..sources.pages import build_docket_pages, build_saved_again, build_search_pages, read_saved_pages, write_page_files
from ..sources.store import read_daily, write_daily
from . import tidy as T
from . import tidy_fast as TF

Query = Callable[[SparkSession, str], DataFrame]


def _cases(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(cases_for(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _header_cols(*cols):
    return lambda cases: H.header_table(cases).select("n_processo", "file", *cols)


def _litigation_type(cases):
    t = PA.with_party_flags(PA.party_sides(cases))
    return t.select("n_processo", "file", "ativo_pj", "passivo_pj", "part_tipo_litigio")


def _party_display(cases):
    return PA.party_table(cases).select("n_processo", "file", "part_ativo", "part_passivo")


def _distinct_names(cases):
    return C.unnest_child(cases, "parts", ["name"]).select("name").distinct()


def _fixed_names(cases):
    return _distinct_names(cases).select("name", fix_names("name").alias("name_fixed"))


def _legal_person(cases):
    n = _distinct_names(cases)
    plain = unaccent(F.col("name"))
    fixed = fix_names(plain)
    staged = n.select("name", plain.alias("_p"), fixed.alias("_f"))
    return staged.select("name", legal_person_from(F.col("_p"), F.col("_f")).alias("is_pj"),
                         display_from_fixed(F.col("_f")).alias("display_name"))


def _legal_person_narrow(cases):
    return _distinct_names(cases).select(
        "name", is_legal_person("name", dictionary="narrow").alias("is_pj_narrow"))


def _party_rows(cases):
    return C.unnest_child(cases, "parts", ["name"]).select(
        F.col("id1").alias("n_processo"), "file", "pos", "name")


def _name_labels(d):
    """Per distinct raw name: fixed name, company label, segment."""
    fixed = fix_names(unaccent(F.col("name")))
    staged = d.select("name", fixed.alias("name_fixed"))
    folded = staged.select("*", CO.company_label(F.col("name_fixed")).alias("company"))
    return folded.select("*", CO.segment_label(F.col("company")).alias("segment"))


def _major_companies(cases):
    t = CO.label_distinct(_party_rows(cases), "name", _name_labels)
    return t.select("n_processo", "file", "pos", "name_fixed", "company")


def _market_segment(cases):
    t = CO.label_distinct(_party_rows(cases), "name", _name_labels)
    return t.select("n_processo", "file", "pos", "company", "segment")


def _titles(cases):
    long = H.header_long(cases)
    return PR.with_titles(long.groupBy(F.col("data").alias("code"))
                          .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")), "code", "title")


AS_OF = "2024-01-01"


def docket_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = build_docket_pages(Fixtures(spark, sf_dir))
    return MV.tidy_movements(MV.parse_pages(pages))


def page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MV.page_counts(build_docket_pages(Fixtures(spark, sf_dir)))


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SE.flatten_results(build_search_pages(Fixtures(spark, sf_dir)))


def lawsuit_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SE.lawsuit_ids(search_results(spark, sf_dir))


def daily_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the day-partitioned search results, read every day back."""
    path = scratch_path(spark, "store", _fingerprint(spark, sf_dir), "search_index")
    write_daily(search_results(spark, sf_dir), path, order_cols=["n_result"])
    return read_daily(spark, path, "id_lawsuit STRING, n_result BIGINT, sg_date DATE")


def stored_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved pages to the tidy table: page movements become the records'
    movements, records are stored by day, the table is made from the store.
    Many pages were saved more than once."""
    cases = cases_for(spark, sf_dir)
    none = F.lit(None).cast(cases.schema["output"].dataType["movs"].dataType)
    cases = cases.withColumn("output", F.col("output").withField("movs", none))
    parsed = stored(MV.parse_pages(build_saved_again(build_docket_pages(Fixtures(spark, sf_dir)))), "parsed-pages")
    path = scratch_path(spark, "store", _fingerprint(spark, sf_dir), f"cases-{uuid.uuid4().hex}")
    write_case_days(MV.merge_movements(cases, parsed, as_of="2099-12-31"), path)
    return TF.tidy_cases_fast(read_case_days(spark, path))


def bucketed_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tidy table from records that are bucketed by case key once."""
    path = scratch_path(spark, "bucketed", _fingerprint(spark, sf_dir), uuid.uuid4().hex)
    cases = cases_for(spark, sf_dir)
    return T.tidy_cases(write_cases_by_key(cases, path, C.case_tasks(cases)))


def _page_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a file for every docket page."""
    folder = scratch_path(spark, "files", _fingerprint(spark, sf_dir), uuid.uuid4().hex)
    write_page_files(build_docket_pages(Fixtures(spark, sf_dir)), folder, F.when(F.regexp_extract("file", "([0-9]+)", 1).cast("bigint") % 10 == 3, "other").otherwise("page"))
    return folder


def _about() -> Column:
    """The docket file a page is about, in its text."""
    return F.regexp_extract(F.decode("html", "UTF-8"), r"pages/[0-9]+\.html", 0)


def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4: saved files whose path matches a regex, read and parsed."""
    pages = read_saved_pages(spark, _page_files(spark, sf_dir), name_regex="kind=page/", recursive=True, partition_bytes=32 << 20)
    # each file is a page of its own, also where another one about the same docket file was saved at the same time
    page = F.concat("file", F.lit("\n"), _about())
    parsed = MV.parse_pages(pages.select(page.alias("file"), F.lit(None).cast("date").alias("sg_date"), "html", "read"))
    got = MV.nested_movements(parsed)
    return got.select(F.substring_index("file", "\n", -1).alias("file"), F.col("page_return").alias("status"), F.size("movs").cast("bigint").alias("n_movements"))


def saved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5: every saved file, by absolute path; here with what its path says."""
    pages = read_saved_pages(spark, _page_files(spark, sf_dir), recursive=True, partition_bytes=32 << 20)
    path = F.col("file")
    return pages.select(_about().alias("about"), F.regexp_extract(path, "kind=([a-z]+)/", 1).alias("kind"),
                        F.startswith(path, F.lit("/")).alias("absolute"))


def streamed_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page job as a stream: pages land as files, an ``availableNow``
    stream parses them into the day-partitioned store, which is read back.
    Some days were fetched twice; their first fetch had other pages."""
    from ..streaming.daily_ingest import run_once
    run = scratch_path(spark, "stream", _fingerprint(spark, sf_dir), uuid.uuid4().hex)
    second = build_docket_pages(Fixtures(spark, sf_dir)).withColumn("fetch", F.col("sg_date").cast("timestamp") + F.expr("INTERVAL 20 HOURS"))
    first = second.where(F.day("sg_date") % 4 == 1).select(
        F.concat(F.lit("old/"), "file").alias("file"), "sg_date", "html", (F.col("fetch") - F.expr("INTERVAL 12 HOURS")).alias("fetch"))
    pages = second.unionByName(first)
    # by day, a large one in several parts: ranges would make every page twice, to find their bounds
    pages.hint("rebalance", "sg_date").write.mode("overwrite") \
        .option("compression", "zstd").parquet(run + "/pages")
    out = run_once(spark, run + "/pages", run + "/store", run + "/checkpoint")
    return out.select("file", "sg_date", "pos", "movement", "title", "txt")


def ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = Fixtures(spark, sf_dir).fx_people
    return people.select("person_id",
                         PR.age_from_serial(F.col("nasc_serial"), AS_OF).alias("idade"),
                         PR.age_from_year(F.col("nasc_text"), AS_OF).alias("idade_ano"))


def _person_keys(cases):
    names = C.unnest_child(cases, "parts", ["name"]).select(PR.person_key(F.col("name")).alias("person_key"))
    return names.groupBy("person_key").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


QUERIES: dict[str, Query] = {
    "parse_status": _cases(C.parse_status),
    "ok_cases": _cases(C.ok_case_summary),
    "header_keys_kept": _cases(H.kept_keys_of),
    "header_values_joined": _cases(H.header_values),
    "header_wide": _cases(H.header_wide),
    "chamber_profile": _cases(_header_cols("info_camara_nm", "info_camara_num",
                                           "info_camara_tipo", "info_camara_regime")),
    "area_family": _cases(_header_cols("info_area")),
    "origin_split": _cases(_header_cols("info_comarca", "info_foro")),
    "subject_split": _cases(_header_cols("info_assunto_full", "info_assunto_pai",
                                         "info_assunto_filho")),
    "claim_value": _cases(_header_cols("info_cruzeiro", "info_valor")),
    "header_table": _cases(H.header_table),
    "party_sides": _cases(PA.party_sides),
    "litigation_type": _cases(_litigation_type),
    "party_display": _cases(_party_display),
    "party_table": _cases(PA.party_table),
    "case_gaps": _cases(MO.case_gaps),
    "case_durations": _cases(MO.case_durations),
    "decisions_labelled": _cases(lambda c: DE.labelled_decisions(c).drop("src_row", "pos")),
    "latest_decision": _cases(DE.latest_decision),
    "tidy_cases": _cases(T.tidy_cases),
    "tidy_cases_fast": _cases(TF.tidy_cases_fast),
    "litigation_summary": _cases(T.litigation_summary),
    "fixed_names": _cases(_fixed_names),
    "legal_person": _cases(_legal_person),
    "legal_person_narrow": _cases(_legal_person_narrow),
    "major_companies": _cases(_major_companies),
    "market_segment": _cases(_market_segment),
    "criminal_outcomes": _cases(lambda c: PR.criminal_outcomes(T.tidy_cases(c))),
    "titles": _cases(_titles),
    "person_keys": _cases(_person_keys),
    "ages": ages,
    "docket_movements": docket_movements,
    "page_status": page_status,
    "search_results": search_results,
    "lawsuit_ids": lawsuit_ids,
    "bucketed_tidy": bucketed_tidy,
    "saved_pages": saved_pages,
    "saved_files": saved_files,
    "daily_store": daily_store,
    "streamed_movements": streamed_movements,
    "stored_tidy": stored_tidy,
}

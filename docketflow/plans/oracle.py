"""DuckDB SQL for every registered query (the correctness oracle).

The fixture CTEs are the same SQL text the Spark side runs; everything
after them is written independently in plain SQL over the FLAT fixture
tables (no nesting), with DuckDB's own functions: ordered ``string_agg``
for ordered concatenation, ``row_number`` for "newest decision", ``lag``
for gaps, first-match ``regexp_replace`` (DuckDB's default) for the name
fixes.  Regexes are RE2 here and Java on the Spark side.
"""

from __future__ import annotations

from ..functions import decisions as D
from ..functions import names as N
from ..functions.rules import COMARCA_FIXES, COMPANY_RULES, SEGMENT_RULES, as_patterns
from ..functions.text import ACCENTED, BR_NUMBER, UNACCENTED
from ..operators import header as H
from ..operators import parties as P
from ..sources.fixtures import duckdb_ctes


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sq(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def unacc(x: str) -> str:
    return f"translate({x}, {q(ACCENTED)}, {q(UNACCENTED)})"


def clean_key(x: str) -> str:
    return f"lower({unacc(sq(x))})"


def rm(x: str, pattern: str, ci: bool = False) -> str:
    return f"regexp_matches({x}, {q(pattern)}{', ' + q('i') if ci else ''})"


def rep1(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)})"


def fix_sql(x: str) -> str:
    s = f"lower({x})"
    s = rep1(s, N.SA_GENERAL, N.SA_GENERAL_TO)
    s = rep1(s, N.SA_PARTICULAR, N.SA_PARTICULAR_TO)
    s = rep1(s, N.SA_ESTACIO, N.SA_ESTACIO_TO)
    s = sq(s)
    s = rep1(s, N.LTDA_GENERAL, N.LTDA_GENERAL_TO)
    s = rep1(s, N.ME_GENERAL, N.ME_GENERAL_TO)
    s = rep1(s, N.ME_PARTICULAR, N.ME_PARTICULAR_TO)
    return f"regexp_replace({s}, {q(N.PUNCTUATION)}, '', 'g')"


def pj_sql(plain: str, fixed: str, words: str = N.PJ_WIDE) -> str:
    return (f"(({rm(plain, words, True)} OR contains({fixed}, '@')) "
            f"AND NOT {rm(fixed, N.PJ_BLOCK, True)})")


def in_list(vals) -> str:
    return "(" + ", ".join(q(v) for v in vals) + ")"


def case_first(x: str, rules, default: str | None = None, ci: bool = False) -> str:
    parts = [f"WHEN {rm(x, p, ci)} THEN {q(lab)}" for p, lab in rules]
    tail = f" ELSE {q(default)}" if default is not None else ""
    return "CASE " + " ".join(parts) + tail + " END"


def case_last(x: str, rules) -> str:
    parts = [f"WHEN {rm(x, p)} THEN {q(lab)}" for lab, p in reversed(list(rules))]
    return "CASE " + " ".join(parts) + f" ELSE {x} END"


def outcome_sql(x: str) -> str:
    def h(p):
        return rm(x, p, True)
    return (f"CASE WHEN {h(D.PARTIAL)} THEN 'parcial' "
            f"WHEN {h(D.NEGATIVE)} AND {h(D.POSITIVE)} THEN 'parcial' "
            f"WHEN {h(D.NEGATIVE)} THEN 'negou' WHEN {h(D.POSITIVE)} THEN 'aceitou' "
            f"WHEN {h(D.SETTLEMENT)} THEN 'acordo' WHEN {h(D.KNOWN)} THEN 'não conhecido' "
            f"WHEN {h(D.DILIGENCE)} THEN 'diligência' WHEN {h(D.MOOT)} THEN 'prejudicado' "
            f"WHEN {h(D.WITHDRAWAL)} THEN 'desistência' WHEN {h(D.ANNULLED)} THEN 'anulado' "
            f"WHEN {h(D.EXTINCT)} THEN 'extinto' ELSE 'outro' END")


def unanimity_sql(x: str) -> str:
    return (f"CASE WHEN {rm(x, D.UNANIMOUS, True)} THEN 'unanime' "
            f"WHEN {rm(x, D.MAJORITY, True)} THEN 'maioria' ELSE 'outro' END")


def with_(*ctes: str, fixtures=None) -> str:
    return "WITH " + ",\n".join([duckdb_ctes(fixtures)] + [c for c in ctes if c])


# --- shared CTEs --------------------------------------------------------------

OK = "ok AS (SELECT id1, file, k FROM fx_case WHERE status <> 'error')"

H_LONG = f"""h_long AS (SELECT o.id1, o.file, o.k * 1000 + d.pos AS pos, {clean_key('d.data')} AS data, d.value
  FROM ok o JOIN fx_data d ON d.k = o.k)"""
H_CNT = "h_cnt AS (SELECT data, count(*) AS n FROM h_long GROUP BY data)"
H_KEPT = """h_kept AS (SELECT l.* FROM h_long l JOIN h_cnt c ON l.data IS NOT DISTINCT FROM c.data
  WHERE c.n > 1)"""
H_VALS = """h_first AS (SELECT id1, file, data, value, min(pos) AS p FROM h_kept
  GROUP BY id1, file, data, value),
h_vals AS (SELECT id1, file, data, string_agg(coalesce(value, 'NA'), '@' ORDER BY p) AS value
  FROM h_first GROUP BY id1, file, data)"""
H_WIDE = "h_wide AS (SELECT id1 AS n_processo, file, " + ", ".join(
    f"max(CASE WHEN data = {q(k)} THEN value END) AS {H.column_name(k)}" for k in H.HEADER_KEYS
) + " FROM h_vals GROUP BY id1, file)"

_fam = (f"CASE WHEN area2 = 'Privado' AND cam IN {in_list(H.FAMILY_CHAMBERS)} THEN 'Família' "
        f"WHEN area2 = 'Privado' AND cam IN {in_list(H.CONTRACT_CHAMBERS)} THEN 'Contratos' "
        f"WHEN area2 = 'Privado' AND cam IN {in_list(H.PROPERTY_CHAMBERS)} THEN 'Imobiliário' "
        f"WHEN area2 = 'Criminal' THEN 'Criminal' END")
_kind = "CASE " + " ".join(f"WHEN {rm('distribuicao', p)} THEN {q(lab)}"
                           for p, lab in H.CHAMBER_KIND_RULES) + " END"
_regime = (f"CASE WHEN {rm('distribuicao', H.CHAMBER_EXTRAORDINARY)} THEN 'Extraordinária' "
           f"WHEN {rm('distribuicao', H.CHAMBER_ORDINARY)} THEN 'Ordinária' ELSE 'Outro' END")
_com_clean = f"upper({unacc(sq('com0'))})"
_com = ("CASE " + " ".join(f"WHEN com1 = {q(a)} THEN {q(b)}" for a, b in COMARCA_FIXES)
        + " ELSE com1 END")
_br = f"TRY_CAST(replace(replace(regexp_extract(valor_da_acao, {q(BR_NUMBER)}, 0), '.', ''), ',', '.') AS DOUBLE)"

H_STAGE = f"""h_s1 AS (SELECT *, nullif(regexp_extract(distribuicao, '[0-9]+'), '') AS c0,
    CASE WHEN area IS NULL THEN NULL WHEN area = 'Criminal' THEN 'Criminal' ELSE 'Privado' END AS area2,
    string_split(origem, ' / ') AS og
  FROM h_wide),
h_s2 AS (SELECT *, CASE WHEN length(c0) < 2 THEN lpad(c0, 2, '0') ELSE c0 END AS cam,
    CASE WHEN {rm('og[1]', 'Comarca de ')} THEN regexp_extract(og[1], 'Comarca de (.*)', 1) END AS com0,
    CASE WHEN len(og) >= 2 THEN og[2] END AS foro0
  FROM h_s1),
h_s3 AS (SELECT *, {_com_clean} AS com1 FROM h_s2),
header AS (SELECT n_processo, file,
    {_fam} AS info_area,
    classe AS info_classe,
    assunto AS info_assunto_full,
    CASE WHEN strpos(assunto, '-') > 0 THEN regexp_extract(assunto, '^(.*?) ?- ?', 1) ELSE assunto END AS info_assunto_pai,
    CASE WHEN strpos(assunto, '-') > 0 THEN regexp_extract(assunto, '^.*? ?- ?(.*)$', 1) END AS info_assunto_filho,
    distribuicao AS info_camara_nm,
    cam AS info_camara_num,
    {_kind} AS info_camara_tipo,
    {_regime} AS info_camara_regime,
    relator AS info_relator,
    {_com} AS info_comarca,
    foro0 AS info_foro,
    situacao AS info_status,
    regexp_matches(valor_da_acao, '[cC]') AS info_cruzeiro,
    {_br} AS info_valor
  FROM h_s3)"""

HEADER_CTES = [OK, H_LONG, H_CNT, H_KEPT, H_VALS, H_WIDE, H_STAGE]

_side = (f"CASE WHEN role IN {in_list(P.ACTIVE_ROLES)} THEN 'ativo' "
         f"WHEN role IN {in_list(P.PASSIVE_ROLES)} THEN 'passivo' "
         f"WHEN role IN {in_list(P.LAWYER_ROLES)} AND part IN {in_list(P.PASSIVE_ROLES)} THEN 'passivo_adv' "
         f"WHEN role IN {in_list(P.LAWYER_ROLES)} AND part IN {in_list(P.ACTIVE_ROLES)} THEN 'ativo_adv' "
         f"ELSE 'outro' END")
P_LONG = f"""p_long AS (SELECT o.id1, o.file, o.k * 1000 + p.pos AS pos, p.name, lower(p.role) AS role, lower(p.part) AS part
  FROM ok o JOIN fx_parts p ON p.k = o.k),
p_side AS (SELECT *, {_side} AS tipo_parte FROM p_long)"""
P_WIDE = "p_wide AS (SELECT id1 AS n_processo, file, " + ", ".join(
    f"string_agg(coalesce(name, 'NA'), chr(10) ORDER BY pos) FILTER (WHERE tipo_parte = {q(s)}) AS {s}"
    for s in P.SIDES) + " FROM p_side GROUP BY id1, file)"
P_FLAGS = f"""p_fix AS (SELECT *, {unacc('ativo')} AS pa, {unacc('passivo')} AS pp,
    {fix_sql(unacc('ativo'))} AS fa, {fix_sql(unacc('passivo'))} AS fp FROM p_wide),
p_flags AS (SELECT *, {pj_sql('pa', 'fa')} AS ativo_pj, {pj_sql('pp', 'fp')} AS passivo_pj FROM p_fix),
parties AS (SELECT n_processo, file,
    upper(replace(fa, '@', '')) AS part_ativo, ativo_adv AS part_ativo_adv,
    upper(replace(fp, '@', '')) AS part_passivo, passivo_adv AS part_passivo_adv,
    CASE WHEN ativo_pj AND passivo_pj THEN 'nPF-nPF' WHEN ativo_pj AND NOT passivo_pj THEN 'nPF-PF'
         WHEN NOT ativo_pj AND passivo_pj THEN 'PF-nPF' WHEN NOT ativo_pj AND NOT passivo_pj THEN 'PF-PF'
    END AS part_tipo_litigio
  FROM p_flags)"""
PARTY_CTES = [OK, P_LONG, P_WIDE, P_FLAGS]

M_CTES = [OK, """m_long AS (SELECT o.id1, o.file, m.movement FROM ok o JOIN fx_movs m ON m.k = o.k
  WHERE m.movement > DATE '2000-01-01'),
gaps AS (SELECT id1 AS n_processo, file, movement,
    CAST(date_diff('day', coalesce(lag(movement) OVER (PARTITION BY id1, file ORDER BY movement),
                                   DATE '1970-01-01'), movement) AS BIGINT) AS gap_days
  FROM m_long),
durations AS (SELECT n_processo, file,
    CAST(date_diff('day', min(movement), max(movement)) AS DOUBLE) AS time_tot,
    CAST(coalesce(sum(CASE WHEN gap_days < 1095 THEN gap_days END), 0) AS DOUBLE) AS time_clean
  FROM gaps GROUP BY n_processo, file)"""]

E_CTES = [OK, f"""e_lab AS (SELECT o.id1 AS n_processo, o.file, o.k * 1000 + e.pos AS pos, e.dec_date,
    {outcome_sql('e.decision')} AS dec_val, e.decision, {unanimity_sql('e.decision')} AS dec_unanime
  FROM ok o JOIN fx_decisions e ON e.k = o.k
  WHERE e.decision IS NOT NULL AND NOT {rm('e.decision', D.EXCLUDED, True)}),
latest AS (SELECT n_processo, file, dec_date, dec_val, decision, dec_unanime FROM (
    SELECT *, row_number() OVER (PARTITION BY n_processo, file
                                 ORDER BY dec_date DESC NULLS LAST, pos) AS rn FROM e_lab) t
  WHERE rn = 1)"""]

_crim = (f"CASE WHEN info_area = 'Criminal' AND info_classe IN "
         f"('Mandado de Segurança', 'Habeas Corpus', 'Revisão Criminal') THEN 'Writ' "
         f"WHEN info_area = 'Criminal' AND info_classe IN "
         f"('Apelação', 'Agravo de Execução Penal', 'Recurso em Sentido Estrito') THEN 'Recurso' "
         f"ELSE 'Não é criminal' END")
def _same(a: str, b: str) -> str:
    """The same case: equal, or both NULL."""
    return (f"{a}.n_processo IS NOT DISTINCT FROM {b}.n_processo "
            f"AND {a}.file IS NOT DISTINCT FROM {b}.file")


TIDY = f"""tidy AS (SELECT h.*, p.part_ativo, p.part_ativo_adv, p.part_passivo, p.part_passivo_adv,
    p.part_tipo_litigio, m.time_tot, m.time_clean, e.dec_date, e.dec_val, e.decision, e.dec_unanime,
    {_crim} AS info_classe_crim
  FROM header h JOIN parties p ON {_same('h', 'p')} JOIN durations m ON {_same('h', 'm')}
  LEFT JOIN latest e ON {_same('h', 'e')})"""


def _uniq(ctes):
    seen, out = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return out


TIDY_CTES = _uniq(HEADER_CTES + PARTY_CTES + M_CTES + E_CTES + [TIDY])

_cr1 = list(D.CRIMINAL_APPEAL_RULES)
_crim_text = f"lower({unacc('decision')})"


def _crim_case(rules, default):
    return "CASE " + " ".join(f"WHEN {rm(_crim_text, p)} THEN {q(lab)}" for p, lab in rules) \
        + f" ELSE {q(default)} END"


# distinct party names of parsed cases (for the name operators)
NAMES = "names AS (SELECT DISTINCT p.name FROM ok o JOIN fx_parts p ON p.k = o.k)"
PARTY_ROWS = "prow AS (SELECT o.id1 AS n_processo, o.file, CAST(p.pos AS INTEGER) AS pos, p.name, p.label, p.segment FROM ok o JOIN fx_parts p ON p.k = o.k)"
_company = case_last("name_fixed", as_patterns(COMPANY_RULES))
_segment = case_last("company", as_patterns(SEGMENT_RULES))

AS_OF = "2024-01-01"

ORACLE: dict[str, str] = {
    "parse_status": with_(OK, fixtures=["fx_case"]) + """
SELECT CAST(count(*) AS BIGINT) AS n_files,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS n_error,
       CAST(count(*) FILTER (WHERE status IS NULL) AS BIGINT) AS n_no_status,
       CAST(count(*) FILTER (WHERE status <> 'error') AS BIGINT) AS n_ok
FROM fx_case""",
    "ok_cases": with_(OK) + """
SELECT o.id1 AS n_processo, o.file,
  CAST((SELECT count(*) FROM fx_data d WHERE d.k = o.k) AS BIGINT) AS n_data,
  CAST((SELECT count(*) FROM fx_parts p WHERE p.k = o.k) AS BIGINT) AS n_parts,
  CAST((SELECT count(*) FROM fx_movs m WHERE m.k = o.k) AS BIGINT) AS n_movs,
  CAST((SELECT count(*) FROM fx_decisions e WHERE e.k = o.k) AS BIGINT) AS n_decisions
FROM ok o""",
    "header_keys_kept": with_(OK, H_LONG, H_CNT) + """
SELECT data, CAST(n AS BIGINT) AS n FROM h_cnt WHERE n > 1""",
    "header_values_joined": with_(OK, H_LONG, H_CNT, H_KEPT, H_VALS) + """
SELECT id1 AS n_processo, file, data, value FROM h_vals""",
    "header_wide": with_(OK, H_LONG, H_CNT, H_KEPT, H_VALS, H_WIDE) + """
SELECT * FROM h_wide""",
    "chamber_profile": with_(*HEADER_CTES) + """
SELECT n_processo, file, info_camara_nm, info_camara_num, info_camara_tipo, info_camara_regime
FROM header""",
    "area_family": with_(*HEADER_CTES) + """
SELECT n_processo, file, info_area FROM header""",
    "origin_split": with_(*HEADER_CTES) + """
SELECT n_processo, file, info_comarca, info_foro FROM header""",
    "subject_split": with_(*HEADER_CTES) + """
SELECT n_processo, file, info_assunto_full, info_assunto_pai, info_assunto_filho FROM header""",
    "claim_value": with_(*HEADER_CTES) + """
SELECT n_processo, file, info_cruzeiro, info_valor FROM header""",
    "header_table": with_(*HEADER_CTES) + """
SELECT * FROM header""",
    "party_sides": with_(OK, P_LONG, P_WIDE) + """
SELECT n_processo, file, ativo, ativo_adv, passivo, passivo_adv FROM p_wide""",
    "litigation_type": with_(*PARTY_CTES) + """
SELECT p.n_processo, p.file, p.ativo_pj, p.passivo_pj, t.part_tipo_litigio
FROM p_flags p JOIN parties t ON """ + _same("p", "t"),
    "party_display": with_(*PARTY_CTES) + """
SELECT n_processo, file, part_ativo, part_passivo FROM parties""",
    "party_table": with_(*PARTY_CTES) + """
SELECT * FROM parties""",
    "case_gaps": with_(*M_CTES) + """
SELECT * FROM gaps""",
    "case_durations": with_(*M_CTES) + """
SELECT * FROM durations""",
    "decisions_labelled": with_(*E_CTES) + """
SELECT n_processo, file, dec_date, dec_val, decision, dec_unanime FROM e_lab""",
    "latest_decision": with_(*E_CTES) + """
SELECT * FROM latest""",
    "tidy_cases": with_(*TIDY_CTES) + """
SELECT * FROM tidy""",
    "litigation_summary": with_(*_uniq(PARTY_CTES + M_CTES)) + """
SELECT p.part_tipo_litigio, CAST(count(*) AS BIGINT) AS n_cases,
       CAST(sum(m.time_clean) AS DOUBLE) AS sum_time_clean,
       CAST(avg(m.time_clean) AS DOUBLE) AS mean_time_clean
FROM parties p JOIN durations m ON """ + _same("p", "m") + """
GROUP BY p.part_tipo_litigio""",
    "fixed_names": with_(OK, NAMES) + f"""
SELECT name, {fix_sql('name')} AS name_fixed FROM names""",
    "legal_person": with_(OK, NAMES) + f"""
SELECT name, {pj_sql(unacc('name'), fix_sql(unacc('name')))} AS is_pj,
       upper(replace({fix_sql(unacc('name'))}, '@', '')) AS display_name FROM names""",
    "legal_person_narrow": with_(OK, NAMES) + f"""
SELECT name, {pj_sql(unacc('name'), fix_sql(unacc('name')), N.PJ_NARROW)} AS is_pj_narrow FROM names""",
    "major_companies": with_(OK, PARTY_ROWS) + f"""
SELECT n_processo, file, pos, name_fixed, coalesce(label, {_company}) AS company
FROM (SELECT *, {fix_sql(unacc('name'))} AS name_fixed FROM prow) t""",
    "market_segment": with_(OK, PARTY_ROWS) + f"""
SELECT n_processo, file, pos, company, coalesce(segment, {_segment}) AS segment
FROM (SELECT *, coalesce(label, {_company}) AS company
      FROM (SELECT *, {fix_sql(unacc('name'))} AS name_fixed FROM prow) t0) t""",
    "criminal_outcomes": with_(*TIDY_CTES) + f"""
SELECT n_processo, file, info_classe_crim, decision,
  CASE WHEN info_classe_crim = 'Recurso' THEN {_crim_case(_cr1, D.CRIMINAL_APPEAL_DEFAULT)}
       ELSE {_crim_case(D.CRIMINAL_WRIT_RULES, D.CRIMINAL_WRIT_DEFAULT)}
  END AS crim_outcome
FROM tidy WHERE info_classe_crim IN ('Writ', 'Recurso')""",
    "titles": with_(OK, H_LONG) + """
SELECT data AS code, CAST(count(*) AS BIGINT) AS n_rows, """ + (
        "CASE data WHEN 'nome' THEN 'Nome' WHEN 'info_assunto' THEN 'Assunto' WHEN 'assunto' THEN 'Assunto' "
        "WHEN 'camara' THEN 'Câmara' WHEN 'area' THEN 'Área' WHEN 'faculdade' THEN 'Faculdade' "
        "WHEN 'origem' THEN 'Origem' WHEN 'idade' THEN 'Idade' WHEN 'tem_pos' THEN 'Tem pós' "
        "WHEN 'tempo_form' THEN 'Tempo formado' WHEN 'tempo_' THEN 'Tempo tribunal' "
        "WHEN 'tempo_2inst' THEN 'Tempo tribunal' WHEN 'cidade' THEN 'Cidade origem' END"
    ) + """ AS title FROM h_long GROUP BY data""",
}
ORACLE["tidy_cases_fast"] = ORACLE["bucketed_tidy"] = ORACLE["tidy_cases"]

_sqp = "trim(regexp_replace(replace({x}, chr(160), ' '), '\\s+', ' ', 'g'))"

ORACLE.update({
    "docket_movements": with_(fixtures=["fx_page_rows", "fx_page_files"]) + f""",
pr AS (SELECT f.file, f.sg_date, r.pos, r.date_txt, r.title, r.body
       FROM fx_page_files f JOIN fx_page_rows r ON r.k = f.k WHERE f.shape = 'table')
SELECT file, sg_date, CAST(pos AS INTEGER) AS pos,
       CAST(try_strptime(replace(trim(date_txt), '-', '/'), '%d/%m/%Y') AS DATE) AS movement,
       {_sqp.format(x='title')} AS title, {_sqp.format(x='body')} AS txt
FROM pr WHERE trim(date_txt) <> ''""",
    "page_status": with_(fixtures=["fx_page_rows", "fx_page_files"]) + """
SELECT sg_date, CAST(count(*) FILTER (WHERE shape <> 'table') AS BIGINT) AS n_error,
       CAST(count(*) FILTER (WHERE shape = 'table' AND EXISTS
            (SELECT 1 FROM fx_page_rows r WHERE r.k = f.k)) AS BIGINT) AS n_pages_with_rows
FROM fx_page_files f GROUP BY sg_date""",
    "saved_pages": with_(fixtures=["fx_page_rows", "fx_page_files"]) + """
SELECT file, CASE WHEN shape = 'table' THEN 'result' ELSE 'error' END AS status,
       CAST(CASE WHEN shape = 'table' THEN (SELECT count(*) FROM fx_page_rows r WHERE r.k = f.k AND trim(date_txt) <> '') ELSE 0 END AS BIGINT) AS n_movements
FROM fx_page_files f WHERE shape <> 'missing' AND k % 10 <> 3""",
    "saved_files": with_(fixtures=["fx_page_files"]) + """
SELECT file AS about, CASE WHEN k % 10 = 3 THEN 'other' ELSE 'page' END AS kind, true AS absolute
FROM fx_page_files WHERE shape <> 'missing'""",
    "search_results": with_(fixtures=["fx_index"]) + """
SELECT sg_date, id_lawsuit, k AS n_result FROM fx_index""",
    "lawsuit_ids": with_(fixtures=["fx_index"]) + """
SELECT sg_date, regexp_replace(id_lawsuit, '[^0-9]', '', 'g') AS id_lawsuit
FROM (SELECT DISTINCT sg_date, id_lawsuit FROM fx_index) t""",
    "daily_store": with_(fixtures=["fx_index"]) + """
SELECT id_lawsuit, k AS n_result, sg_date FROM fx_index""",
    "ages": with_(fixtures=["fx_people"]) + f"""
SELECT person_id,
  CAST(date_diff('day', DATE '1900-01-01' + CAST(TRY_CAST(nasc_serial AS DOUBLE) AS INTEGER),
                 DATE '{AS_OF}') AS DOUBLE) / 365.242 AS idade,
  CAST({AS_OF[:4]} AS DOUBLE) - TRY_CAST(nullif(regexp_extract(nasc_text, '[0-9]{{4}}'), '') AS DOUBLE) AS idade_ano
FROM fx_people""",
    "person_keys": with_(OK) + f"""
SELECT coalesce(nullif(regexp_extract(nm, '^[A-Z]+'), ''), 'NA') || ' ' ||
       coalesce(nullif(regexp_extract(nm, '[A-Z]+$'), ''), 'NA') AS person_key,
       CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT {sq(unacc('upper(p.name)'))} AS nm FROM ok o JOIN fx_parts p ON p.k = o.k) t
GROUP BY 1""",
})
ORACLE["streamed_movements"] = ORACLE["docket_movements"]

# pages -> records -> store -> tidy: the page's rows are the case's movements,
# and a page that cannot be read drops its record
_PAGE_OK = """ok AS (SELECT c.id1, c.file, c.k FROM fx_case c LEFT JOIN fx_page_files f ON f.file = c.file
  WHERE c.status <> 'error' AND coalesce(f.shape, 'table') = 'table'{rows})"""
_PAGE_MOVS = """m_long AS (SELECT o.id1, o.file, p.movement FROM ok o JOIN fx_page_files f ON f.file = o.file
  JOIN (SELECT k, CAST(try_strptime(replace(trim(date_txt), '-', '/'), '%d/%m/%Y') AS DATE) AS movement
        FROM fx_page_rows WHERE trim(date_txt) <> '') p ON p.k = f.k
  WHERE p.movement > DATE '2000-01-01')"""
_movs = M_CTES[1]
ORACLE["stored_tidy"] = with_(*[_PAGE_OK.format(rows="") if c == OK else _PAGE_MOVS + _movs[_movs.index(",\ngaps AS"):] if c == _movs else c
                               for c in TIDY_CTES]) + """
SELECT * FROM tidy"""

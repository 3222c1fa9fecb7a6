"""Golden rows for the string operators (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from docketflow.functions.decisions import decision_outcome, unanimity
from docketflow.functions.names import fix_names
from docketflow.functions.text import parse_real
from docketflow.operators.companies import company_label, segment_label
from docketflow.functions.rules import COMPANY_RULES

FIXED = [
    ("Banco Itau S/A", "banco itau @s@a@"),
    ("Itau Unibanco S.A.", "itau unibanco @s@a@"),
    ("Claro SA", "claro @s@a@"),
    ("Nextel Telecomunicacoes Ltda.", "nextel telecomunicacoes @l@t@d@a@"),
    ("Padaria Joao L.T.D.A", "padaria joao @l@t@d@a@"),
    ("Loja Boa M.E.", "loja boa @m@e@"),
    ("Loja Boa ME", "loja boa @m@e@"),
    ("Mercado M/E de Santos", "mercado @m@e@ de santos"),
    ("Telefone S A", "telefone @s@a@"),
    ("Estacio de Sa", "estacio de @s@a@"),
    ("Estacio de Sa Ltda", "estacio de @s@a@ @l@t@d@a@"),
    ("Maria de Sa", "maria de @s@a@"),
    ("Joao da Silva", "joao da silva"),
    ("Joao da Silva\nBanco do Brasil S/A", "joao da silva banco do brasil @s@a@"),
    ("Padaria ME\nJose Souza", "padaria me jose souza"),
    ("C&A Modas Ltda", "ca modas @l@t@d@a@"),
    ("Casas/Apto Bento", "casa @s@a@pto bento"),
    ("Condominio Sol", "condominio sol"),
    ("Defensoria Publica", "defensoria publica"),
    ("a  &  b", "a  b"),
    ("Empresa S/A (em recuperacao)", "empresa @s@a@ em recuperacao"),
    ("x@y", "x@y"),
    ("Cia S A e Filhos S/A", "cia @s@a@ e filhos @s@a@"),
    ("Volta da Silva", "volta da silva"),
    ("Felt da Rosa", "fe@l@t@d@a@ rosa"),
]

DECISIONS = [
    ("Negaram provimento ao recurso. V. U.", "negou", "unanime"),
    ("Deram provimento ao recurso, por maioria", "aceitou", "maioria"),
    ("Deram parcial provimento. V.U.", "parcial", "unanime"),
    ("Recurso desprovido", "parcial", "outro"),
    ("NÃO PROVIDO, unânime", "parcial", "unanime"),
    ("Julgaram improcedente", "parcial", "outro"),
    ("Não conheceram do recurso", "não conhecido", "outro"),
    ("Homologaram o acordo", "acordo", "outro"),
    ("Converteram em diligência", "diligência", "outro"),
    ("Julgaram prejudicado", "prejudicado", "outro"),
    ("Homologada a desistência", "desistência", "outro"),
    ("Anularam a sentença", "anulado", "outro"),
    ("Extinto o processo", "extinto", "outro"),
    ("Vencido o relator, mantiveram", "negou", "maioria"),
    ("Adequaram o voto (DE2 would drop it)", "outro", "outro"),
    ("Indeferiram o pedido. VU", "negou", "unanime"),
    ("Sentença reformada", "aceitou", "outro"),
    ("Nada consta", "outro", "outro"),
    ("Indefiro; deram vista", "parcial", "outro"),
]

CLAIMS = [("R$ 1.234,56", 1234.56), ("Cr$ 10.000,00", 10000.0), ("112.946,26", 112946.26),
          ("sem valor", None), ("R$ 0,01@R$ 2,00", 0.01), ("-5", -5.0), ("R$ ,50", 0.5),
          (None, None)]

COMPANIES = [("banco itau", "regex_itau", "bancos_cartoes_financeiras"),
             ("prefeitura de rio claro", "regex_rio_claro", "telecomunicacoes"),
             ("casas bahia", "regex_vvar", "varejo"),
             ("banco ford", "regex_ford", "bancos_cartoes_financeiras"),
             ("vitima", "regex_tim", "telecomunicacoes"),
             ("cce brasil", "regex_cce", "fabricantes_eletrocnicos"),
             ("joao da silva", "joao da silva", "joao da silva")]

SEGMENT_CLOSURE = {"ministerio_publico": 1, "fazenda": 1, "municipio": 1, "telecomunicacoes": 8,
                   "bancos_cartoes_financeiras": 36, "comercio_eletronico": 2, "banco_de_dados": 4,
                   "fabricantes_eletrocnicos": 7, "varejo": 7, "transporte_aereo": 5, "seguros": 6,
                   "energia_gas_agua_esgoto": 11, "fabricantes_linha_branca": 7,
                   "agencias_de_viagem": 1, "programas_de_fidelidade": 4, "planos_de_saude": 3,
                   "recuperacao_credito": 3, "perfumaria": 2, "supermercados": 1}


def test_fixed_names(spark):
    df = spark.createDataFrame(FIXED, "name string, expected string")
    got = df.select("expected", fix_names("name").alias("got")).collect()
    assert [(r.expected, r.got) for r in got] == [(e, e) for _, e in FIXED]


def test_decision_labels(spark):
    df = spark.createDataFrame(DECISIONS, "d string, label string, unan string")
    got = df.select(decision_outcome("d").alias("a"), unanimity("d").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(l, u) for _, l, u in DECISIONS]


def test_claim_values(spark):
    df = spark.createDataFrame(CLAIMS, "v string, x double")
    got = [r[0] for r in df.select(parse_real("v")).collect()]
    assert got == [x for _, x in CLAIMS]


def test_company_and_segment(spark):
    df = spark.createDataFrame(COMPANIES, "n string, l string, s string")
    got = df.select(company_label(F.col("n")).alias("l")) \
            .select("l", segment_label(F.col("l")).alias("s")).collect()
    assert [(r.l, r.s) for r in got] == [(l, s) for _, l, s in COMPANIES]


def test_segment_closure_over_all_labels(spark):
    labels = sorted({lab for lab, _ in COMPANY_RULES})
    assert len(COMPANY_RULES) == 136 and len(labels) == 135
    df = spark.createDataFrame([(x,) for x in labels], "l string")
    seg = df.select("l", segment_label(F.col("l")).alias("s"))
    counts = {r.s: r.n for r in seg.filter("s <> l").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert counts == SEGMENT_CLOSURE
    assert seg.filter("s = l").count() == 25

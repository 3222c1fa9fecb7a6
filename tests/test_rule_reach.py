"""Every reachable label of the ordered rule lists, with what is expected
written out."""

import pytest
from pyspark.sql import functions as F

from docketflow.functions.decisions import criminal_appeal_outcome, criminal_writ_outcome
from docketflow.functions.names import fix_names
from docketflow.functions.rules import COMPANY_RULES, SEGMENT_RULES
from docketflow.functions.text import unaccent
from docketflow.operators.companies import company_label, segment_label
from docketflow.sources.brands import BRANDS

APPEALS = [
    ("Julgaram prejudicado", "prejudicado/extinto"), ("Extinta a punibilidade", "prejudicado/extinto"), ("Desprovido o recurso", "improvido"),
    ("Recurso não provido", "improvido"), ("Negaram provimento", "improvido"), ("Proveram o recurso", "provido"), ("Mantiveram a sentença", "improvido"),
    ("Recurso acolhido", "provido"), ("Deram provimento", "provido"), ("Parcial provimento", "provido"), ("Nego seguimento", "improvido"),
    ("Recurso não conhecido", "não conhecido"), ("Desconhecido", "desconhecido"), ("Não  conheceram", "desconhecido"),
    ("Homologaram o acordo", "desistência"), ("Anularam a sentença", "anulado"), ("Convertido em diligência", "conversão em diligência"),
    ("Nada consta", "outro"), (None, "outro"),
]
WRITS = [
    ("Ordem prejudicada", "prejudicado/extinto"), ("Indeferiram a ordem", "denegado"), ("Deferiram a ordem", "concedido"),
    ("Por maioria, deferiram", "concedido"), ("Desproveram", "denegado"), ("Não provido", "improvido"), ("Proveram", "concedido"),
    ("Deram parcial provimento", "concedido"), ("Absolveram o réu", "concedido"), ("Acolheram o pedido", "concedido"),
    ("Julgaram procedente", "concedido"), ("Denegaram a ordem", "denegado"), ("Concederam a ordem", "concedido"),
    ("Conheceram do pedido", "concedido"), ("Não conheceram", "não conhecido"), ("Desconhecido", "desconhecido"),
    ("Homologada a desistência", "desistência"), ("Por votação unânime e concederam", "concedido"), ("Nada consta", "outros"),
]


@pytest.mark.parametrize("rules, outcome", [(APPEALS, criminal_appeal_outcome), (WRITS, criminal_writ_outcome)])
def test_criminal_outcomes(spark, rules, outcome):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rules)], "i int, t string")
    got = [r.o for r in df.select("i", outcome(F.col("t")).alias("o")).orderBy("i").collect()]
    assert got == [o for _, o in rules]


def test_brands(spark):
    df = spark.createDataFrame(BRANDS, "name string, label string, segment string")
    got = df.select("name", company_label(fix_names(unaccent(F.col("name")))).alias("l"))
    got = {r["name"]: (r.l, r.s) for r in got.select("*", segment_label(F.col("l")).alias("s")).collect()}
    assert got == {n: (label, seg) for n, label, seg in BRANDS}


def test_reach():
    labels = {label for _, label, _ in BRANDS}
    assert {r for r, _ in COMPANY_RULES} - labels == {
        "regex_ca", "regex_estacio_de_sa", "regex_banco_vxolkswagen", "regex_banco_fxord", "regex_banco_fxiat", "regex_banco_hxonda"}
    assert {s for s, _ in SEGMENT_RULES} <= {seg for _, _, seg in BRANDS}

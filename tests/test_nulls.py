"""One test per NULL/ordering trap of the reference's semantics."""

from pyspark.sql import functions as F

from docketflow.operators.durations import case_durations
from docketflow.operators.header import area_family, chamber_number, comarca
from docketflow.operators.parties import litigation_type, party_sides
from docketflow.plans.tidy import criminal_class
from docketflow.sources.inputs import CASES_SCHEMA


def test_chamber_number_pads_without_truncating(spark):
    df = spark.createDataFrame([("3ª Câmara",), ("123ª Câmara",), ("Câmara Especial",), (None,)], "d string")
    assert [r[0] for r in df.select(chamber_number(F.col("d"))).collect()] == ["03", "123", None, None]


def test_null_area_stays_null(spark):
    df = spark.createDataFrame([(None, "05"), ("Cível", "05"), ("Criminal", "99"), ("Cível", None)],
                               "a string, c string")
    got = [r[0] for r in df.select(area_family(F.col("a"), F.col("c"))).collect()]
    assert got == [None, "Família", "Criminal", None]


def test_comarca_fix_and_missing(spark):
    df = spark.createDataFrame([("Comarca de Mogi-Guaçu / Foro",), ("Foro / x",), (None,)], "o string")
    assert [r[0] for r in df.select(comarca(F.col("o"))).collect()] == ["MOGI GUACU", None, None]


def test_litigation_type_three_valued(spark):
    df = spark.createDataFrame([(True, None), (None, False), (False, False), (True, False)],
                               "a boolean, p boolean")
    got = [r[0] for r in df.select(litigation_type(F.col("a"), F.col("p"))).collect()]
    assert got == [None, None, "PF-PF", "nPF-PF"]


def test_criminal_class_defaults(spark):
    df = spark.createDataFrame([("Criminal", "Habeas Corpus"), (None, "Habeas Corpus"),
                                ("Criminal", "Apelação"), ("Criminal", None)], "a string, c string")
    got = [r[0] for r in df.select(criminal_class(F.col("a"), F.col("c"))).collect()]
    assert got == ["Writ", "Não é criminal", "Recurso", "Não é criminal"]


def _case(spark, parts=(), movs=()):
    import datetime as dt
    row = ("f1", "result", ("id1", [], list(parts), list(movs), []))
    return spark.createDataFrame([row], CASES_SCHEMA)


def test_null_names_print_na_and_outro_only_case_keeps_a_row(spark):
    c = _case(spark, parts=[("A", "Apelante", "Apelante"), (None, "Apelante", "APELANTE"),
                            ("Z", "x", "Testemunha")])
    r = party_sides(c).collect()[0]
    assert r.ativo == "A\nNA" and r.passivo is None
    c2 = _case(spark, parts=[("Z", "x", "Testemunha")])
    assert party_sides(c2).count() == 1


def test_empty_gap_sum_is_zero(spark):
    import datetime as dt
    c = _case(spark, movs=[(dt.date(2005, 1, 1), "t", None), (dt.date(1999, 1, 1), "t", None)])
    r = case_durations(c).collect()[0]
    assert (r.time_tot, r.time_clean) == (0.0, 0.0)

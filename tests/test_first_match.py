"""Property check: the Spark first-match replacement and the full name fix
equal an independent Python implementation (``re.sub(..., count=1)``) on
random strings built from the characters the patterns care about."""

import random
import re

from pyspark.sql import functions as F

from docketflow.functions import names as N
from docketflow.functions.text import replace_first

ALPHABET = list("sa/. ltdme()") + ["\n", "de ", "s/a", "ltda", " me", "estacio de sa", "&", "-"]


def _py_rep(rep: str) -> str:
    return rep  # Python uses the same \1 syntax; absent groups expand to ''


def _py_sub1(pattern, rep, s):
    return re.sub(pattern, lambda m: re.sub(r"\\(\d)", lambda g: m.group(int(g.group(1))) or "", rep),
                  s, count=1)


def _py_fix(s):
    s = s.lower()
    s = _py_sub1(N.SA_GENERAL, N.SA_GENERAL_TO, s)
    s = _py_sub1(N.SA_PARTICULAR, N.SA_PARTICULAR_TO, s)
    s = _py_sub1(N.SA_ESTACIO, N.SA_ESTACIO_TO, s)
    s = re.sub(r"\s+", " ", s).strip(" ")
    s = _py_sub1(N.LTDA_GENERAL, N.LTDA_GENERAL_TO, s)
    s = _py_sub1(N.ME_GENERAL, N.ME_GENERAL_TO, s)
    s = _py_sub1(N.ME_PARTICULAR, N.ME_PARTICULAR_TO, s)
    return re.sub(N.PUNCTUATION, "", s)


def _strings(n=600, seed=7):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_replace_first_matches_python(spark):
    data = _strings()
    df = spark.createDataFrame([(s,) for s in data], "s string")
    cases = [(N.SA_PARTICULAR, N.SA_PARTICULAR_TO), (N.LTDA_GENERAL, N.LTDA_GENERAL_TO),
             (N.ME_PARTICULAR, N.ME_PARTICULAR_TO), ("a", "<\\0>".replace("\\0", "x"))]
    cols = [replace_first(F.col("s"), p, r).alias(f"c{i}") for i, (p, r) in enumerate(cases)]
    cols += [replace_first(F.col("s"), N.SA_GENERAL, N.SA_GENERAL_TO, end_anchored=True).alias("e0"),
             replace_first(F.col("s"), N.ME_GENERAL, N.ME_GENERAL_TO, end_anchored=True).alias("e1")]
    got = df.select("s", *cols).collect()
    for r in got:
        for i, (p, rep) in enumerate(cases):
            assert r[f"c{i}"] == _py_sub1(p, rep, r.s), (p, r.s)
        assert r.e0 == _py_sub1(N.SA_GENERAL, N.SA_GENERAL_TO, r.s), r.s
        assert r.e1 == _py_sub1(N.ME_GENERAL, N.ME_GENERAL_TO, r.s), r.s


def test_fix_names_matches_python(spark):
    data = _strings(seed=11)
    df = spark.createDataFrame([(s,) for s in data], "s string")
    for r in df.select("s", N.fix_names("s").alias("f")).collect():
        assert r.f == _py_fix(r.s), repr(r.s)


def _py_parse_real(s):
    if s is None:
        return None
    m = re.search(r"-?(?:[0-9][0-9.]*(?:,[0-9]*)?|,[0-9]+)", s)
    if not m:
        return None
    t = m.group(0).replace(".", "").replace(",", ".")
    try:
        return float(t)
    except ValueError:
        return None


def test_parse_real_matches_python(spark):
    from docketflow.functions.text import parse_real
    rnd = random.Random(5)
    parts = ["R$ ", "Cr$ ", "1", "23", "4.567", ",", ".", "-", "89", " ", "@", "abc", ",5"]
    data = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 6))) for _ in range(800)]
    df = spark.createDataFrame([(s,) for s in data], "s string")
    for r in df.select("s", parse_real("s").alias("v")).collect():
        assert r.v == _py_parse_real(r.s), repr(r.s)

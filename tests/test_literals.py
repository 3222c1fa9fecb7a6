"""Rules found by their literals give the labels of the plain rule chain."""

import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketflow.functions.literals import any_literal, branches, last_rule, needed
from docketflow.functions.rules import COMPANY_RULES, SEGMENT_RULES, as_patterns
from docketflow.functions.text import last_match_label


def test_needed_literals():
    assert needed("itau") == "itau" and needed("( |^)oi( |$)") == "oi" and needed("casa[s]? bahia") == " bahia"
    assert needed("a.c*de+f?g{2}") == "de" and needed(r"\d\.x") == "x" and needed("(a|b)") == ""
    assert branches("(cdl|camara( de)? x)") == ["cdl", "camara( de)? x"] and branches("(a|b)(c|d)") == ["(a|b)(c|d)"]
    assert branches("a|(b|c)") == ["a", "(b|c)"] and branches("[|]|x") == ["[|]", "x"]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([a for r in (COMPANY_RULES, SEGMENT_RULES) for _, alts in r for a in alts]), st.data())
def test_a_match_holds_its_literal(pattern, data):
    text = data.draw(st.from_regex(pattern))
    assert any(needed(b) in text and re.search(b, text) for b in branches(pattern))
    for rules in (COMPANY_RULES, SEGMENT_RULES):
        if any(re.search(a, text) for _, alts in rules for a in alts):
            assert re.search(any_literal(rules), text)


def _names(n):
    """Names around the rules' words, whole, cut and changed, and plain ones."""
    rng = random.Random(7)
    words = [w for r in (COMPANY_RULES, SEGMENT_RULES) for label, alts in r for a in [*alts, label] for w in [re.sub(r"[\[\]()?^$|+.*]", "", a)]]
    plain = "maria jose silva souza oliveira comercio de materiais ltda sa banco transportes @l@t@d@a@ santos".split()
    for _ in range(n):
        parts = [rng.choice(plain) for _ in range(rng.randrange(1, 4))]
        if rng.random() < 0.7:
            w = rng.choice(words)
            k = rng.randrange(len(w) + 1)
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([w, w[:k] + w[k + 1:], w[:k] + " " + w[k:], w.replace(" ", "")]))
        yield " ".join(parts)


def test_labels_as_the_plain_chain(spark):
    df = spark.createDataFrame([(n,) for n in _names(6000)] + [(None,), ("",), ("c&a",), ("net",), ("the net",)], "n string").cache()
    for rules in (COMPANY_RULES, SEGMENT_RULES):
        both = df.select("n", last_rule(F.col("n"), rules).alias("a"), last_match_label("n", as_patterns(rules)).alias("b"))
        assert both.where("NOT a <=> b").collect() == []
        assert both.where("a <> n").select("a").distinct().count() > 15


def test_different_names_are_cheap(spark):
    """Mostly different names, as in a table of persons."""
    rng = random.Random(3)
    first, last = "maria jose antonio ana joao carlos paulo lucia marcos helena".split(), "silva souza oliveira pereira lima costa rocha dias".split()
    rows = [(f"{rng.choice(first)} {rng.choice(last)} {k}",) for k in range(60_000)]
    df = spark.createDataFrame(rows, "n string").repartition(4).cache()
    df.count()

    def seconds(label):
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            df.select(label.alias("x")).agg(F.max("x")).collect()
            best = min(best, time.perf_counter() - start)
        return best
    assert 2 * seconds(last_rule(F.col("n"), COMPANY_RULES)) < seconds(last_match_label("n", as_patterns(COMPANY_RULES)))

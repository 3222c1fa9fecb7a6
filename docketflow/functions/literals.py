"""An index of ordered regex rules by the literals they need.

A rule is a list of alternatives.  An alternative without any regex sign is a
literal, and ``contains`` answers it; one with regex signs needs the longest
plain run that every match of it holds, and its regex is only tried where that
run occurs.  All literals together form one prefix tree, written as a regex:
a text in which it finds nothing meets no rule at all.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGNS = set(r".^$*+?{}[]\|()")


def branches(pattern: str) -> list[str]:
    """The alternatives of a pattern, also of one that is a single group."""
    parts, depth, start, i, closed = [], 0, 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 2)
        elif c in "()":
            depth += 1 if c == "(" else -1
            closed += not depth
        elif c == "|" and not depth:
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    parts.append(pattern[start:])
    if closed == 1 and pattern[:1] == "(" and pattern[-1:] == ")" and pattern[1:2] != "?":
        return branches(pattern[1:-1])
    return parts


def needed(pattern: str) -> str:
    """The longest run of plain characters that every match of ``pattern``,
    which has no alternatives outside of groups, holds; ``""`` if none is
    sure.  What stands in groups and classes or is repeated doesn't count."""
    best, run, depth, i = "", "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[":
            i, c = pattern.index("]", i + 2), ""
        elif c == "{":
            i, c = pattern.index("}", i), ""
        elif c == "\\":
            i, c = i + 1, ""
        elif c in "()":
            depth, c = depth + (1 if c == "(" else -1), ""
        sure = c and c not in _SIGNS and not depth and pattern[i + 1:i + 2] not in ("?", "*", "{")
        run = run + c if sure else ""
        best = max(best, run, key=len)
        i += 1
    return best


def _tree(words: list[str]) -> str:
    """The words as one regex in which no two branches begin alike."""
    if "" in words:
        return ""  # a shorter word is found where a longer one is
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[0], []).append(w[1:])
    branches = [re.escape(h) + _tree(rest) for h, rest in sorted(heads.items())]
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def any_literal(rules) -> str | None:
    """A regex found in every text that some rule matches, or None if a rule
    needs no literal."""
    words = sorted({needed(b) for _, alternatives in rules for a in alternatives for b in branches(a)})
    return None if "" in words else _tree(words)


def found(text: Column, alternatives: list[str]) -> Column:
    """Whether one of the alternatives is found in ``text``; its literal is
    looked for before the regex is tried."""
    def one(pattern: str) -> Column:
        word = needed(pattern)
        if word == pattern:
            return text.contains(word)
        return text.contains(word) & text.rlike(pattern) if word else text.rlike(pattern)
    return reduce(or_, (one(b) for a in alternatives for b in branches(a)))


def last_rule(text: Column, rules) -> Column:
    """Label of the last of the ordered ``(label, alternatives)`` rules that
    is found in ``text``; no rule leaves the text."""
    chain = None
    for label, alternatives in reversed(list(rules)):
        hit = found(text, alternatives)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    chain = chain.otherwise(text)
    some = any_literal(rules)
    return chain if some is None else F.when(text.rlike(some), chain).otherwise(text)

"""String expressions (``Column -> Column``), all JVM-side.

Semantics follow the R/ICU behaviour of the reference where it differs
from Java's defaults:

* whitespace means Unicode White_Space (``\\s`` in Java misses NBSP);
* ``str_replace`` replaces the *first* match only, while Spark's
  ``regexp_replace`` replaces all -- :func:`replace_first` anchors a lazy
  prefix so only the leftmost match is rewritten;
* splitting "into n pieces, rest merged, missing pieces NA" is
  ``split(limit=n)`` + ``get`` (``get`` yields NULL out of range, ``[]``
  would raise under ANSI).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Accent folding used by the reference's helper (Latin letters with acute,
# grave, circumflex, tilde, umlaut and cedilla to their base letter; other
# characters such as the ordinal indicators are left alone).  Two strings of
# equal length, position i maps to position i.
ACCENTED = ("áéíóúÁÉÍÓÚýÝ" "àèìòùÀÈÌÒÙ" "âêîôûÂÊÎÔÛ" "ãõÃÕñÑ" "äëïöüÄËÏÖÜÿ" "çÇ")
UNACCENTED = ("aeiouAEIOUyY" "aeiouAEIOU" "aeiouAEIOU" "aoAOnN" "aeiouAEIOUy" "cC")
# ----------------------------------------------------------------------------

assert len(ACCENTED) == len(UNACCENTED)

WHITESPACE_RUN = r"\p{IsWhite_Space}+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squish(c: Column | str) -> Column:
    """Collapse every whitespace run to one blank and trim the ends."""
    return F.trim(F.regexp_replace(col(c), WHITESPACE_RUN, " "))


def unaccent(c: Column | str) -> Column:
    return F.translate(col(c), ACCENTED, UNACCENTED)


def clean_key(c: Column | str) -> Column:
    """Header key normalisation: squish, strip accents, lower."""
    return F.lower(unaccent(squish(c)))


def clean_place(c: Column | str) -> Column:
    """Place-name normalisation: squish, strip accents, upper."""
    return F.upper(unaccent(squish(c)))


_GROUP_REF = re.compile(r"\\(\d)")


def replace_first(c: Column | str, pattern: str, replacement: str,
                  end_anchored: bool = False) -> Column:
    """Replace the leftmost match of ``pattern`` only.

    ``replacement`` uses R-style ``\\1`` group references.  The pattern is
    prefixed by a lazy ``\\A(.*?)`` group, so group numbers shift by one;
    the engine still finds the leftmost match and, thanks to ``\\A``, only
    one.  Groups that did not take part expand to the empty string.

    ``end_anchored=True`` declares that every match must end at the end of
    the text (a trailing ``$`` and at least one consumed character), so at
    most one match exists and a plain replace-all is the same, with the
    engine's fast scanning.  Each call references ``c`` once, so chained
    calls stay linear in size.
    """
    def java(rep: str, shift: int) -> str:
        return _GROUP_REF.sub(lambda m: "$" + str(int(m.group(1)) + shift),
                              rep.replace("$", r"\$"))

    if end_anchored:
        return F.regexp_replace(col(c), pattern, java(replacement, 0))
    return F.regexp_replace(col(c), r"\A((?s:.*?))(?:" + pattern + ")", "$1" + java(replacement, 1))


def split_get(c: Column | str, sep_regex: str, pieces: int, index: int) -> Column:
    """Piece ``index`` (0-based) of ``c`` split into at most ``pieces``."""
    return F.get(F.split(col(c), sep_regex, pieces), index)


def pad2(c: Column | str) -> Column:
    """Left-pad with zeros to width 2 without truncating longer strings."""
    x = col(c)
    return F.when(F.length(x) < 2, F.lpad(x, 2, "0")).otherwise(x)


# First number in Brazilian notation: optional sign, digits with '.'
# grouping and an optional ',' decimal part, or a bare ',50'.
BR_NUMBER = r"-?(?:[0-9][0-9.]*(?:,[0-9]*)?|,[0-9]+)"


def parse_real(c: Column | str) -> Column:
    """Parse the first Brazilian-format number in the text, else NULL."""
    num = F.regexp_extract(col(c), BR_NUMBER, 0)
    plain = F.translate(F.translate(num, ".", ""), ",", ".")
    return F.when(col(c).isNotNull(), plain.try_cast("double"))


def rx(pattern: str, ignore_case: bool = False) -> str:
    """Java flags matching an ICU case-insensitive regex (Unicode folding)."""
    return ("(?iu)" + pattern) if ignore_case else pattern


def detect(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    return col(c).rlike(rx(pattern, ignore_case))


def first_match_label(c: Column | str, rules, default=None,
                      ignore_case: bool = False) -> Column:
    """``case_when`` over ordered ``(pattern, label)`` rules: first hit wins."""
    x = col(c)
    expr = None
    for pattern, label in rules:
        cond = detect(x, pattern, ignore_case)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def last_match_label(c: Column | str, rules, ignore_case: bool = False) -> Column:
    """Ordered ``(label, pattern)`` rules where the *last* hit wins and no hit
    keeps the input: a first-match CASE over the reversed rule list."""
    x = col(c)
    expr = None
    for label, pattern in reversed(list(rules)):
        cond = detect(x, pattern, ignore_case)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(x)

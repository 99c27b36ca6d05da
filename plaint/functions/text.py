"""Column expressions over text: narrative hygiene, snippets, state codes."""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: redaction token and whitespace patterns ------------------
# Two or more X's standing as a whole word (the source redacts PII as XXXX).
# Word edges are spelled out so Java and RE2 agree on non-ASCII neighbours.
# It begins with the letter, so that other characters are passed at once.
REDACTION_PATTERN = r"X(?<![A-Za-z0-9_]X)X+(?![A-Za-z0-9_])"
# white space that is not one space already
WHITESPACE_PATTERN = r"\s(?:\s+|(?<! ))"
# Python's str.strip() removes all whitespace; Spark's trim() only spaces.
_LEAD_WS = r"^\s+"
_TRAIL_WS = r"\s+$"
_WHITE = " \t\n\x0b\f\r"
# `$` stands before one of these at the end, too
_LINE_ENDS = ("\x85", "\u2028", "\u2029")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Strip leading/trailing whitespace of any kind (tabs, newlines too)."""
    rare = reduce(or_, [_c(c).endswith(x) for x in _LINE_ENDS])
    return F.when(rare, F.regexp_replace(F.regexp_replace(_c(c), _LEAD_WS, ""), _TRAIL_WS, "")).otherwise(F.btrim(_c(c), F.lit(_WHITE)))


def clean_narrative(c) -> Column:
    """Drop redaction tokens, collapse whitespace runs, strip; null -> ''."""
    t = F.coalesce(_c(c), F.lit(""))
    t = F.regexp_replace(t, REDACTION_PATTERN, " ")
    return F.trim(F.regexp_replace(t, WHITESPACE_PATTERN, " "))


def narrative_length(c) -> Column:
    """Code-point length of the cleaned narrative (0 for null)."""
    return F.coalesce(F.length(_c(c)), F.lit(0)).cast("int")


def has_text(c) -> Column:
    return (narrative_length(c) > 0).cast("int")


def fill_unknown(c) -> Column:
    """null -> 'Unknown', then strip (a blank-only value becomes '')."""
    return py_strip(F.coalesce(_c(c), F.lit("Unknown")))


def snippet(c, n: int = 240, ellipsis: str = "…") -> Column:
    """First n characters, with an ellipsis appended when the text is longer."""
    t = F.coalesce(_c(c), F.lit(""))
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit(ellipsis))).otherwise(t)


def truncate(c, n: int) -> Column:
    return F.substring(F.coalesce(_c(c), F.lit("")), 1, n)


def state_code(c) -> Column:
    """Upper-cased, trimmed state; null unless exactly two letters."""
    s = F.upper(py_strip(_c(c)))
    return F.when(s.rlike(r"^[A-Z]{2}$"), s)


def upper_equals(c, target: str) -> Column:
    """Case-insensitive equality to a target name, null -> ''."""
    return F.upper(F.coalesce(_c(c), F.lit(""))) == F.lit(target.upper())


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test, null -> false."""
    return F.coalesce(F.lower(_c(c)).contains(needle.lower()), F.lit(False))

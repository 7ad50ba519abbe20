"""Text expressions shared by the operators. All are built-in JVM functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java needs (?U) before \s, \d, \w and \b mean what they mean in Unicode text.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only the blank."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def fold(text: Column) -> Column:
    """Lower case that also maps the four letters whose case pair is ASCII."""
    return F.lower(F.translate(text, "ſKİı", "skii"))


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == F.lit(""))


def sql_text(value: str) -> str:
    """A string literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def contains_any(text: Column, words) -> Column:
    return any_of([F.contains(text, F.lit(w)) for w in words])


def quoted(name: Column) -> Column:
    r"""A regex that matches the name itself (\Q...\E, safe for an inner \E)."""
    return F.concat(F.lit("\\Q"), F.replace(name, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def whole_word(text: Column, name: Column, compat: bool = False) -> Column:
    r"""Whether the name occurs between word edges.

    ``compat`` uses \b on both sides, under which a name that ends in a
    non-word character can never match.
    """
    edge = ("(?U)\\b", "\\b") if compat else ("(?U)(?<![\\p{L}\\p{N}_])", "(?![\\p{L}\\p{N}_])")
    return F.contains(text, name) & F.rlike(text, F.concat(F.lit(edge[0]), quoted(name), F.lit(edge[1])))


def empty_strings() -> Column:
    return F.array().cast("array<string>")

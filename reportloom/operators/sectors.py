"""Sector of a title: by company first, then by the longest sector word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.lists import let

WORD_SCHEMA = "word string, sector string, whole boolean"
# Short Latin words also occur inside longer ones ("ai" in "Daily").
SHORT_LATIN = r"^[A-Za-z]{1,3}$"


def sector_dictionary(table: DataFrame, inline_rows: int = D.INLINE_ROWS) -> D.Dictionary:
    """(word, sector) rows, words unique; short Latin words are marked whole-word."""
    marked = table.select("word", "sector", F.rlike("word", F.lit(SHORT_LATIN)).alias("whole"))
    return D.load(marked, inline_rows)


def keyword_sector(title: Column, words: Column, compat: bool = False) -> Column:
    """Longest contained word wins; of equally long ones the greater sector name.

    ``words`` are the contained dictionary rows. Under ``compat`` a short Latin
    word may also match inside a longer one.
    """
    if not compat:
        apart = lambda t, w: F.rlike(t, F.concat(F.lit("(?<![A-Za-z])"), w, F.lit("(?![A-Za-z])")))
        words = let(title, lambda t: F.filter(words, lambda e: ~e["whole"] | apart(t, e["word"])))
    scored = F.transform(words, lambda e: F.struct(F.length(e["word"]).alias("n"), e["sector"].alias("sector")))
    return F.array_max(scored)["sector"]


def sector(by_name: Column, by_word: Column) -> Column:
    return F.coalesce(by_name, by_word, F.lit(""))

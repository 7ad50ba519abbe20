"""Small array expressions."""

from __future__ import annotations

import json
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_where(items: Column, test, field: str | None = None) -> Column:
    """The first item that passes ``test`` (or one of its fields), else null."""
    item = F.get(F.filter(items, test), F.lit(0))
    return item[field] if field else item


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once.

    The optimizer may paste a column's whole definition into the place where it
    is used; inside a lambda it would then run once per array item.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def not_in(items: Column, words) -> Column:
    """Items that are not one of the literal words."""
    return F.filter(items, lambda x: ~x.isin(*words))


def bar(items: Column) -> Column:
    """One comparable string of an array."""
    return F.array_join(items, "|")


def literal_list(words: list[str | None]) -> Column:
    """An array of strings that lives in the plan."""
    return F.from_json(F.lit(json.dumps(words, ensure_ascii=False)), "array<string>")


def listed(by_key: dict[str, list], entry: str):
    """A lookup that lives in the plan: a function from a key's column to an array<entry> with the entries listed under the key.

    Keys lie in buckets by their checksum, since a map of the plan is read from end to end for each key. The few that share a
    bucket come too; the caller tests entries anyway.
    """
    n = 1 << (2 * len(by_key)).bit_length()
    buckets: list[list[dict]] = [[] for _ in range(n)]
    for key, entries in by_key.items():
        buckets[crc32(key.encode()) % n].extend(entries)
    table = F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), f"array<array<{entry}>>")
    return lambda key: F.get(table, F.pmod(F.crc32(key), F.lit(n)).cast("int"))

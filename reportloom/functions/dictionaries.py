"""Which dictionary entries occur in a text, for small and for large dictionaries.

A dictionary is a DataFrame with one distinct ``word`` per row and any payload
columns. Up to ``INLINE_ROWS`` rows (counted before anything is collected) it
becomes one literal map and the test runs inside the projection: no shuffle, no
join. A larger dictionary is joined on short pieces of text. Its words lie under
one piece each. Up to ``BROADCAST_ROWS`` entries go to the tasks whole; beyond,
neither side is ever held whole by a task or by the driver, and a Bloom filter of
the pieces, of bounded size, keeps all other pieces of a text from leaving it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from .lists import let, listed, literal_list
from .text import sql_text

INLINE_ROWS = 4096
PAIR = 2
GRAM = 3
#: Characters of the piece that a word of a large dictionary lies under; names that end in numbers share shorter ones.
ANCHOR = 5
#: A word whose every piece of that length is shared by more than FEW words lies under a longer one, of these lengths.
LONGER, FEW = (8, 12, 20), 4
#: Entries that are broadcast to the texts.
BROADCAST_ROWS = 4 * INLINE_ROWS
#: Bits of the filter: so many per piece, a power of two, and never more than 512 KB of the plan.
BITS_PER_PIECE = 16
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 22
#: Rows of 64 bits, of the filter that is broadcast as a table where the plan has no room for enough bits.
SLOTS = 1 << 20


@dataclass(frozen=True)
class Anchors:
    """The entries of a large dictionary, each under one piece of its word, and what a task needs to tell such pieces."""

    table: DataFrame
    sizes: tuple[int, ...]
    words: tuple[int, ...]
    n_pieces: int
    n_rows: int

    @property
    def crowded(self) -> bool:
        """Whether the filter of the plan lets too many pieces pass by mistake."""
        return 2 * len(self.words) * 64 < BITS_PER_PIECE * self.n_pieces

    def may_have(self, piece: Column) -> Column:
        """False only for pieces that no entry lies under; true by mistake for few others."""
        bits = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        at = _places(piece, len(self.words) * 64)
        return reduce(lambda a, b: a & b, [F.getbit(bits[F.shiftright(x, 6)], x % 64) == 1 for x in at])


def _together(built: list[Anchors]) -> Anchors:
    """One filter for several dictionaries: the smaller ones are repeated to the size of the largest, which keeps their bits."""
    size = max(len(a.words) for a in built)
    words = [reduce(lambda x, y: x | y, w) for w in zip(*[a.words * (size // len(a.words)) for a in built])]
    sizes = tuple(sorted({n for a in built for n in a.sizes}))
    return Anchors(built[0].table, sizes, tuple(words), sum(a.n_pieces for a in built), sum(a.n_rows for a in built))


def _places(piece: Column, n_bits: int) -> list[Column]:
    """The two bits of a piece."""
    h = F.xxhash64(piece)
    return [F.pmod(x, F.lit(n_bits)).cast("int") for x in (h, F.shiftright(h, 32))]


@dataclass(frozen=True)
class Dictionary:
    """``table`` always describes the entries; ``rows`` only when they fit inline.

    Of a large one ``sent`` names the field that goes to a text in place of the whole entry, whose caller tests it, and
    ``place`` the field that says how often a text must have the word at least to need the entry; one of place 0 is
    needed by texts alone that hold ``only_with``.
    """

    table: DataFrame
    entry: T.StructType
    rows: tuple | None
    sent: str | None = None
    place: str | None = None
    only_with: str | None = None

    @property
    def inline(self) -> bool:
        return self.rows is not None

    def under_pieces(self) -> DataFrame:
        """(entry, _gram): the entries, each under one piece of its word.

        Every word lies under that piece of ``ANCHOR`` characters (all of it when it is shorter) which the fewest words
        share, so a beginning common to a third of the words does not matter. Words that differ in their last signs alone
        share all of these; there a longer piece takes its place, so that a piece never stands for many words.
        Exploded pieces pass for a few MB, so by hint no side is broadcast.
        """
        entries = self.table.select(F.struct(*self.entry.names).alias("entry")).where("entry.word <> ''").distinct()
        words = entries.select(F.col("entry.word").alias("word")).distinct()
        every = F.array_distinct(F.flatten(F.array(*[pieces_of(F.col("word"), n) for n in (ANCHOR, *LONGER)])))
        pieces = words.select("word", F.explode(every).alias("_gram"))
        shared = pieces.groupBy("_gram").agg(F.count("*").alias("n"))
        rare = F.struct(F.col("n") > FEW, F.when(F.col("n") <= FEW, F.length("_gram")), "n", "_gram")
        fewest = pieces.join(shared.hint("merge"), "_gram").groupBy("word").agg(F.min_by("_gram", rare).alias("_gram"))
        return entries.join(fewest.hint("merge"), F.col("entry.word") == F.col("word")).select("entry", "_gram")

    @cached_property
    def anchors(self) -> Anchors:
        """Built once, when a large dictionary is first used, and kept in the shared folder."""
        shared_dir(self.table.sparkSession)
        table = self.under_pieces().checkpoint()
        used = table.select("_gram").distinct()
        lengths = used.groupBy(F.length("_gram").alias("size")).agg(F.count("*").alias("n")).collect()
        n_bits = LEAST_BITS
        while n_bits < min(MOST_BITS, BITS_PER_PIECE * sum(r["n"] for r in lengths)):
            n_bits *= 2
        placed = used.select(F.explode(F.array(*_places(F.col("_gram"), n_bits))).alias("at"))
        # one row per 64 bits of the filter at most
        found = placed.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, at % 64))").alias("bits")).collect()
        bits = [0] * (n_bits // 64)
        for r in found:
            bits[r["word"]] = r["bits"]
        return Anchors(table, tuple(sorted(r["size"] for r in lengths)), tuple(bits), sum(r["n"] for r in lengths), table.count())

    def starts(self, field: str = "word") -> dict[str, list[int]]:
        """Per first pair (or single character) of ``field`` the numbers of the rows that begin with it."""
        at = self.entry.names.index(field)
        by_start: dict[str, list[int]] = {}
        for number, row in enumerate(self.rows):
            if row[at]:
                by_start.setdefault(row[at][:PAIR], []).append(number)
        return by_start

    def hits(self, text: str, field: str = "word", pairs: str | None = None) -> Column:
        """Entries whose ``field`` occurs in the column named ``text``.

        The pairs of characters that occur in the text (``pairs``, a column of
        ``pairs_of`` the text that holds at least those of ``starts``) select the
        few entries that begin with one of them; only those are tested. Entries
        go by number until they are found, since each step over structs copies them.
        """
        by_start = self.starts(field)
        if not by_start:
            return F.array().cast(T.ArrayType(self.entry))
        names = self.entry.names
        rows = [dict(zip(names, row)) for row in self.rows]
        entries = F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), T.ArrayType(self.entry))
        words = literal_list([row[field] for row in rows])
        present = F.col(pairs) if pairs else F.expr(pairs_in(text, by_start))
        # rows that lie in one bucket come once for each pair that leads there
        picked = F.array_distinct(F.flatten(F.transform(present, listed(by_start, "int"))))
        found = let(F.col(text), lambda t: F.filter(picked, lambda i: F.contains(t, F.get(words, i))))
        return F.transform(found, lambda i: F.get(entries, i))


def pairs_of(text: str, single: bool = False) -> str:
    """SQL: all pairs of neighbouring characters of the text, with ``single`` all characters too; none for a null text.

    One expression of compiled code, where a lambda over places would be interpreted and walk the text for each.
    """
    pairs = f"regexp_extract_all({text}, '(?s)(?=(..))', 1)"
    if single:
        pairs = f"concat({pairs}, split({text}, ''))"
    return f"coalesce({pairs}, cast(array() as array<string>))"


def pairs_in(text: str, known) -> str:
    """SQL: the distinct first pairs (or single characters) of ``known`` that the text has.

    One SQL text with an IN list becomes a hash set; thousands of literals as
    Column calls would take seconds to build.
    """
    words = ", ".join(sql_text(k) for k in known)
    return f"array_distinct(filter({pairs_of(text, any(len(k) < PAIR for k in known))}, g -> g in ({words})))"


def load(table: DataFrame, inline_rows: int = INLINE_ROWS) -> Dictionary:
    """Look at most ``inline_rows + 1`` rows ahead to pick the form."""
    head = table.limit(inline_rows + 1).collect()
    rows = tuple(tuple(r) for r in head) if len(head) <= inline_rows else None
    return Dictionary(table, table.schema, rows)


def from_rows(spark: SparkSession, rows, schema: str) -> Dictionary:
    table = spark.createDataFrame(list(rows), schema)
    return Dictionary(table, table.schema, tuple(tuple(r) for r in rows))


def _grams(text: Column, size: int) -> Column:
    """All distinct pieces of ``size`` characters of the text."""
    last = F.length(text) - F.lit(size - 1)
    pieces = F.transform(F.sequence(F.lit(1), last), lambda p: F.substr(text, p, F.lit(size)))
    return F.when(last >= 1, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def grams_of(text: Column, most: int = GRAM) -> Column:
    """All distinct pieces of up to ``most`` characters of a text."""
    return F.flatten(F.array(*[_grams(text, n) for n in range(1, most + 1)]))


def pieces_of(word: Column, size: int = GRAM) -> Column:
    """The pieces that a word may lie under: those of ``size`` characters, or all of a shorter word."""
    size = F.least(F.length(word), F.lit(size))
    spots = F.sequence(F.lit(1), F.length(word) - size + 1)
    return F.array_distinct(F.transform(spots, lambda p: F.substr(word, p, size)))


def _slot(h: Column) -> list[Column]:
    """Where a hash lies in the filter that is a table: the row, and two bits of it."""
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftright(h, by).bitwiseAND(F.lit(63)).cast("int")) for by in (32, 40)]
    return [F.pmod(h, F.lit(SLOTS)).alias("_at"), bits[0].bitwiseOR(bits[1]).alias("_bits")]


def _kept(pieces: DataFrame, built: list[Anchors]) -> DataFrame:
    """The pieces that some entry may lie under, and few others, by a filter of at most ``SLOTS`` rows in every task."""
    used = reduce(DataFrame.unionByName, [a.table.select(F.xxhash64("_gram").alias("_h")) for a in built])
    slots = used.select(*_slot(F.col("_h"))).groupBy("_at").agg(F.bit_or("_bits").alias("_known"))
    placed = pieces.select("*", *_slot(F.col("_h"))).join(F.broadcast(slots), "_at")
    return placed.where(F.col("_known").bitwiseAND(F.col("_bits")) == F.col("_bits")).drop("_at", "_bits", "_known")


def nominated(df: DataFrame, key: str, text: str, dictionaries: dict[str, Dictionary], tasks: int | None = None) -> DataFrame:
    """(key, one list per dictionary): per text the entries that lie under one of its pieces; whether they occur whole is tested by the caller.

    A text sends its key and the hashes of those of its pieces that an entry may
    lie under, never itself, once for all dictionaries and once however often it
    has a piece. ``key`` must be unique. Up to ``BROADCAST_ROWS`` entries are
    broadcast. More are met in a merge join by hint: exploded pieces have no
    honest size estimate and must not be broadcast; AQE splits pieces that many
    texts have. Entries go back one by one, to ``tasks`` tasks if given, and are
    made lists there: lists of one or two would be moved, and spilled, at several times the size.
    """
    built = {out: d.anchors for out, d in dictionaries.items()}
    every = _together(list(built.values()))
    # plain expressions of one generated loop; a lambda per piece would be interpreted. The first place is 1, which the optimizer
    # does not know: it would push filters of this side alone below the exchange of the texts, which serves both sides as it is
    first = F.spark_partition_id() * 0 + 1
    signs = {d.only_with for d in dictionaries.values() if d.only_with}
    holds = F.contains(F.col(text), F.lit(*signs)) if len(signs) == 1 else F.lit(True)
    spots = df.select(key, text, holds.alias("_holds"), F.explode(F.sequence(first, F.greatest(F.length(text), F.lit(1)))).alias("_spot"))
    sizes = every.sizes or (ANCHOR,)
    pieces = [x for n in sizes for x in (F.lit(n), F.substr(F.col(text), F.col("_spot"), F.lit(n)))]
    left = spots.select(key, text, "_holds", "_spot", F.stack(F.lit(len(sizes)), *pieces).alias("_size", "_gram"))
    few = every.n_rows <= BROADCAST_ROWS
    # half of a hash: what shares it by chance is tested like what shares a piece
    half = lambda h: F.shiftright(h, 32).cast("int")
    # how often the text has the piece, which is no less than it has words that hold the piece
    if every.crowded and not few:
        # a text that went through the join with the filter would cost more than its few hits put together
        left = _kept(left.select(key, "_holds", F.xxhash64("_gram").alias("_h")), list(built.values()))
        left = left.groupBy(key, half(F.col("_h")).alias("_h")).agg(F.count("*").cast("int").alias("_times"), F.max("_holds").alias("_holds"))
    else:
        # a piece that the end of the text has not cut, where it stands first
        once = (F.length("_gram") == F.col("_size")) & (F.instr(F.col(text), F.col("_gram")) == F.col("_spot"))
        left = left.where(once if few else every.may_have(F.col("_gram")) & once)
        times = (F.length(text) - F.length(F.replace(F.col(text), F.col("_gram"), F.lit("")))) / F.col("_size")
        left = left.select(key, half(F.xxhash64("_gram")).alias("_h"), times.cast("int").alias("_times"), "_holds")
    left = left.select(key, "_h", F.when(F.col("_holds"), F.col("_times")).otherwise(-F.col("_times")).alias("_times"))

    def side(out: str, a: Anchors) -> DataFrame:
        d = dictionaries[out]
        sent = F.col(f"entry.{d.sent}") if d.sent else F.col("entry")
        kind = lambda of: dictionaries[of].entry[dictionaries[of].sent].dataType if dictionaries[of].sent else dictionaries[of].entry
        place = F.col(f"entry.{d.place}") if d.place else F.lit(1)
        return a.table.select(
            half(F.xxhash64("_gram")).alias("_h"), place.alias("_place"), *[(sent if out == of else F.lit(None).cast(kind(of))).alias(of) for of in built]
        )

    right = reduce(DataFrame.unionByName, [side(out, a) for out, a in built.items()])
    met = left.join(right.hint("broadcast" if few else "merge"), "_h")
    met = met.where((F.col("_place") <= F.abs("_times")) & ((F.col("_place") > 0) | (F.col("_times") > 0))).select(key, *built)
    met = met.repartition(tasks, key) if tasks else met.repartition(key)
    return met.groupBy(key).agg(*[F.collect_set(out).alias(out) for out in built])


def with_contained(df: DataFrame, key: str, text: str, dictionary: Dictionary, out: str, tasks: int | None = None) -> DataFrame:
    """Add ``out``: the dictionary entries whose word the text contains."""
    return with_all_contained(df, key, text, {out: dictionary}, tasks=tasks)


def with_all_contained(
    df: DataFrame, key: str, text: str, dictionaries: dict[str, Dictionary], pairs: str | None = None, tasks: int | None = None
) -> DataFrame:
    """Add one column per dictionary: its entries whose word the text contains.

    ``key`` must be unique. The number of words inside one text is bounded by
    the text, so collecting them per key is bounded too. Large dictionaries are
    met together, in one join. ``pairs`` names a column as of ``Dictionary.hits``
    that serves all inline ones. ``tasks``: the number of tasks that ``df`` is
    dealt out to by ``key``, if it is; its rows then stay where they are.
    """
    large = {out: d for out, d in dictionaries.items() if not d.inline}
    if large:
        df = df.join(nominated(df, key, text, {f"_some_{out}": d for out, d in large.items()}, tasks), key, "left")

    def found(out: str, d: Dictionary) -> Column:
        if d.inline:
            return d.hits(text, pairs=pairs)
        some = F.coalesce(f"_some_{out}", F.array().cast(T.ArrayType(d.entry[d.sent].dataType if d.sent else d.entry)))
        if d.sent:
            return some
        return let(F.col(text), lambda t: F.filter(some, lambda e: F.contains(t, e["word"])))

    return df.withColumns({out: found(out, d) for out, d in dictionaries.items()}).drop(*[f"_some_{out}" for out in large])

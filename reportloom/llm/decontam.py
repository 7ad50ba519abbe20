"""Benchmark decontamination: size-partitioned MinHash containment search, exact for short items, confirmed on full shingle sets.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Size classes: class c has documents of up to 2 ** c shingles.
CLASSES = 40
#: Items with fewer distinct shingles are searched by every shingle instead of a sketch, under class 0.
SHORT = 20
#: Rows of the items, sketches or shingles, up to which they are broadcast (40 bytes each); beyond it the same join shuffles.
BROADCAST_ROWS = 500_000


def word_list(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; null is empty."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), "")


def _places(words: str, size: int) -> Column:
    """Where shingles begin; fewer words than ``size`` make one."""
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def hashed_shingles(df: DataFrame, text: str, size: int) -> DataFrame:
    """Adds ``sh``: sorted hashes of the shingles of ``size`` words."""
    named = df.withColumn("w__", F.transform(word_list(F.col(text)), lambda x: F.xxhash64(x))).drop(text)
    one = lambda i: F.xxhash64(*[F.get("w__", i + k) for k in range(size)])
    return named.withColumn("sh", F.sort_array(F.transform(_places("w__", size), one))).drop("w__")


def string_shingles(df: DataFrame, text: str, size: int, name: str) -> DataFrame:
    """Adds the distinct shingles as strings."""
    named = df.withColumn("w__", word_list(F.col(text))).drop(text)
    return named.withColumn(name, F.array_distinct(F.transform(_places("w__", size), lambda i: F.array_join(F.slice("w__", i + 1, size), " ")))).drop("w__")


def _sketch(bits: Column) -> Column:
    """The least hash of each of 2 ** bits bins; a bin is the leading bits, so it is the first of its run in ``sh``."""
    shift = F.lit(64) - bits
    bin_of = lambda x: F.call_function("shiftright", x, shift.cast("int"))
    return F.filter("sh", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get("sh", i - 1))))


def _distinct() -> Column:
    """The hashes of ``sh``, each once."""
    return F.filter("sh", lambda x, i: (i == 0) | (x != F.get("sh", i - 1)))


def _cells(c: Column, hashes: Column) -> Column:
    return F.transform(hashes, lambda x: F.struct(c.cast("int").alias("c"), x.alias("h")))


def _meet(cells: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Documents' cells that an item has too; ``n`` is the number of rows of ``wanted``, as far as it was counted."""
    return cells.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, ["c", "h"])


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, size: int = 5, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of items of which a document holds ``threshold`` or more.

    Containment is the share of the item's distinct shingles of ``size`` words that the document has too (A-Z lower-cased;
    fewer words make one shingle). Null or empty texts contain nothing and are contained in nothing. Rows without id
    are left out; rows of one document are judged each, and the larger share counts; of rows of one item the least text is taken.
    Other columns are not read; an empty side gives an empty result.

    Items of fewer than ``SHORT`` distinct shingles meet every distinct shingle hash of the documents; shared ones are
    counted per document and item, so none is missed. Longer items meet sketches. A document's sketch has one minimum for
    each of as many bins as it has shingles, up to a power of two: its size class. Items are sketched once for every
    class, since a short item keeps its minima only against bins as fine as the document's. A minimum that both sketches
    have makes a candidate: a shared shingle is one with a chance of 0.63 or more, so an item of 20 shingles with 16
    shared is missed with a chance of about 1e-7, longer ones less. Candidates are confirmed on the whole sets of both
    sides as strings. Documents never meet each other. Hashes have 64 bits.
    """
    docs, items = docs.filter(F.col(doc_id).isNotNull()), items.filter(F.col(item_id).isNotNull())
    own_items = items.groupBy(item_id).agg(F.min(F.coalesce(text, F.lit(""))).alias(text))
    # written, since the filters below would otherwise hash an item again for each of its shingles
    hashed = staged(hashed_shingles(own_items, text, size), "items").withColumn("n", F.size(_distinct()))
    every = hashed.filter(F.col("n") < SHORT).select(F.lit(0).alias("c"), item_id, F.explode(_distinct()).alias("h"), "n")
    for_class = hashed.filter(F.col("n") >= SHORT).withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(CLASSES))))
    minima = for_class.select("c", item_id, F.explode(_sketch(F.col("c"))).alias("h"), F.lit(None).cast("int").alias("n"))
    n_every, n_minima = (x.limit(BROADCAST_ROWS + 1).count() for x in (every, minima))

    sized = hashed_shingles(docs.select(doc_id, text), text, size).withColumn(
        "c", F.least(F.lit(CLASSES), F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(F.size("sh"), F.lit(1)))))).cast("int")
    )
    of_short, of_long = _cells(F.lit(0), _distinct()), _cells(F.col("c"), _sketch(F.col("c")))
    in_docs = lambda cells: sized.select(doc_id, F.inline(cells))
    if n_every == 0 or n_minima == 0:
        met = _meet(in_docs(of_long), minima, n_minima) if n_every == 0 else _meet(in_docs(of_short), every, n_every)
    elif n_every + n_minima <= BROADCAST_ROWS:
        # one pass over the documents for both
        met = _meet(in_docs(F.concat(of_short, of_long)), every.unionByName(minima), n_every + n_minima)
    else:
        met = _meet(in_docs(of_short), every, n_every).unionByName(_meet(in_docs(of_long), minima, n_minima))
    counted = met.groupBy(doc_id, item_id).agg(F.count("*").alias("k"), F.max("n").alias("n"))
    # written, since both uses would hash every document again
    found = staged(counted.filter(F.col("n").isNull() | (F.col("k") / F.col("n") >= threshold)).select(doc_id, item_id), "candidates")

    full = string_shingles(docs.select(doc_id, text).join(found.select(doc_id).distinct(), doc_id, "left_semi"), text, size, "in_doc")
    short = string_shingles(own_items, text, size, "in_item")
    both = found.join(full, doc_id).join(short, item_id)
    shared = F.size(F.array_intersect("in_item", "in_doc"))
    return (
        both.select(doc_id, item_id, F.size("in_item").cast("bigint").alias("n_shingles"), shared.cast("bigint").alias("n_shared"))
        .groupBy(doc_id, item_id)
        .agg(F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .filter(F.col("containment") >= threshold)
    )

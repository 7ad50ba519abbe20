"""How filters interact: one table of failing ids per filter, and semi and anti joins of every prefix of every order."""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flat, parts, staged

#: The filters, in the order of their bits in a prefix.
FILTERS = "ABCDE"
_UPPER = bytes(range(65, 91))
_LATER = bytes(range(128, 192))  # all bytes of a character but its first
_SIGNS = b"#$%&*|"
_SPACES = b"\t\n\x0b\x0c\r "
#: Bytes of a text whose words are taken apart at once.
SLICE_BYTES = 1 << 20


def _words(raw: bytes) -> tuple[int, int]:
    """(words, distinct words); a long text is read in slices that end at white space."""
    n, seen, at = 0, set(), 0
    while at < len(raw):
        end = min(at + SLICE_BYTES, len(raw))
        while end < len(raw) and raw[end] not in _SPACES:
            end += 1
        some = raw[at:end].split()
        n += len(some)
        seen.update(some)
        at = end
    return n, len(seen)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, failing array<string>, digest): which of the filters A to D each whole text fails, and its SHA-256."""

    def run(batches):
        for batch in parts(batches):
            data, at = flat(batch.column(1))
            failing, digests = [], []
            for i, j in zip(at[:-1], at[1:]):
                raw = data[i:j].tobytes()
                n, distinct = _words(raw)
                upper = len(raw) - len(raw.translate(None, _UPPER))
                points = len(raw.translate(None, _LATER))
                signs = len(raw) != len(raw.translate(None, _SIGNS))
                bad = (n < 50, 100 * distinct < 65 * n, 100 * upper > 5 * points, signs)
                failing.append([f for f, x in zip(FILTERS, bad) if x])
                digests.append(hashlib.sha256(raw).digest())
            cols = [batch.column(0), batch.column(2), pa.array(failing, pa.list_(pa.string())), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "part", "failing", "digest"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col, F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")).mapInArrow(
        run, f"doc_id {kind}, part string, failing array<string>, digest binary"
    )


def _met(side: DataFrame) -> DataFrame:
    """The side of a join that grows with the documents, never broadcast: packed ids and exploded rows pass for a few MB."""
    return side.hint("merge")


def failing_ids(judged: DataFrame) -> DataFrame:
    """(filter, doc_id): the ids that fail each filter. E: an id that is not the smallest of its text, whoever else fails."""
    plain = judged.select(F.explode("failing").alias("filter"), "doc_id")
    # the smallest id of a text is met again by id, not by text: a text that fills a third of the table is no hot key
    least = _met(judged.groupBy("digest").agg(F.min("doc_id").alias("doc_id")))
    copies = judged.join(least, "doc_id", "left_anti")
    return plain.unionByName(copies.select(F.lit("E").alias("filter"), "doc_id"))


_place = "ascii({}) - 65"  # of a filter in FILTERS
#: Key of a count: the prefix (one bit a filter) and the filter of the step, or 7 for what the whole prefix leaves.
_SURVIVORS = 7


def _prefixes(having: bool) -> Column:
    """All prefixes, as sets of filters, that hold the filter of the row, or all that do not."""
    every = f"sequence(0, {(1 << len(FILTERS)) - 1})"
    return F.expr(f"filter({every}, s -> getbit(s, {_place.format('filter')}) = {int(having)})")


def counts(documents: DataFrame, failing: DataFrame) -> DataFrame:
    """(part, key, n, good, toxic, redundant): per prefix of filters and filter after it, by semi and anti joins on (prefix, id).

    A document that fails j filters enters the joins with at most 32 (1 + j) small rows, one that fails none with none.
    """
    known = failing.join(_met(documents), "doc_id")
    blocked = _met(failing.select(F.explode(_prefixes(True)).alias("prefix"), "doc_id"))
    tries = known.select("filter", "doc_id", "part", "good", "toxic", F.explode(_prefixes(False)).alias("prefix"))
    sums = [F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    none = F.lit(0).cast("bigint")
    key = F.expr(f"prefix * 8 + {_place.format('filter')}").alias("key")
    removed = tries.join(blocked, ["prefix", "doc_id"], "left_anti").groupBy("part", key).agg(*sums).withColumn("redundant", none)
    again = tries.join(blocked, ["prefix", "doc_id"], "left_semi").groupBy("part", key).agg(F.count("*").alias("redundant"))
    again = again.select("part", "key", none.alias("n"), none.alias("good"), none.alias("toxic"), "redundant")
    bad = documents.join(_met(failing), "doc_id", "left_semi").select("doc_id", "part", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))).alias("prefix"))
    left = bad.join(blocked, ["prefix", "doc_id"], "left_anti").groupBy("part", F.expr(f"prefix * 8 + {_SURVIVORS}").alias("key"))
    left = left.agg(F.count("*").alias("n")).select("part", "key", "n", none.alias("good"), none.alias("toxic"), none.alias("redundant"))
    every = removed.unionByName(again).unionByName(left)
    return every.groupBy("part", "key").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic", "redundant")])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step: what the step's filter does after the filters before it.

    A document fails A with under 50 words (runs of bytes other than white space), B if 100 * distinct words < 65 * words,
    C if 100 * capitals A-Z > 5 * code points, D with any of ``# $ % & * |``, E if a smaller id has the same text anywhere
    in the table. Columns: part, filter_order (all 120), step (from 1), kept (after the step), removed (here), redundant (fail
    the step's filter, removed before), unique_fails (fail no other filter), good_lost and toxic_lost (removed here with
    label quality 1 or toxic 1), shapley (removed by the step's filter, summed over all orders); zeros are rows too.

    Null text is empty, a null part the empty string. Rows without id are left out. Rows of one id are one document, that of
    the smallest digest of the text (then the smallest part); labels of an id count if any of its rows has them. Other
    columns are not read. An empty table gives an empty result.

    Texts are read once; then only ids move. The failing ids of each filter are a table of their own in the shared folder.
    """
    judged = judge(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, part_col)
    # a repeated id is settled on digests, after one pass over the texts
    one = judged.groupBy("doc_id").agg(F.min(F.struct("digest", "part", "failing")).alias("d")).select("doc_id", "d.*")
    judged = staged(one, "judged")
    flags = labels.groupBy(F.col("doc_id").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("bigint")).alias("good"), F.max((F.col("toxic") == 1).cast("bigint")).alias("toxic"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    documents = staged(judged.select("doc_id", "part").join(_met(flags), "doc_id", "left").select("doc_id", "part", zero("good"), zero("toxic")), "documents")
    failing = staged(failing_ids(judged), "failing", by="filter")

    stats = counts(documents, failing)
    # at most 112 counts a part
    maps = stats.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("key", F.struct("n", "good", "toxic", "redundant")))).alias("of"))
    parts_ = documents.groupBy("part").agg(F.count("*").alias("total")).join(_met(maps), "part", "left")
    steps = (
        parts_.withColumn("of", F.coalesce("of", F.expr("cast(map() as map<int, struct<n: bigint, good: bigint, toxic: bigint, redundant: bigint>>)")))
        .withColumn("filter_order", F.explode(F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("f", F.expr(_place.format("substr(filter_order, step, 1)")))
        .withColumn("prefix", F.expr(f"aggregate(split(left(filter_order, step - 1), ''), 0, (a, x) -> if(x = '', a, a | shiftleft(1, {_place.format('x')})))"))
    )
    at = lambda key, c: F.coalesce(F.expr(f"try_element_at(of, {key}).{c}"), F.lit(0)).cast("bigint")
    here, others = "prefix * 8 + f", f"({(1 << len(FILTERS)) - 1} - shiftleft(1, f)) * 8 + f"
    after = f"(prefix | shiftleft(1, f)) * 8 + {_SURVIVORS}"
    most = len(FILTERS) - 1
    orders = f"element_at(array({', '.join(str(factorial(k) * factorial(most - k)) for k in range(most + 1))}), bit_count(e.key div 8) + 1)"
    bad_in_all = f"{_SURVIVORS}"  # of the empty prefix: every document that fails any filter
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - at(bad_in_all, "n") + at(after, "n")).alias("kept"),
        at(here, "n").alias("removed"),
        at(here, "redundant").alias("redundant"),
        at(others, "n").alias("unique_fails"),
        at(here, "good").alias("good_lost"),
        at(here, "toxic").alias("toxic_lost"),
        F.expr(f"aggregate(filter(map_entries(of), e -> e.key % 8 = f), 0L, (a, e) -> a + {orders} * e.value.n)").alias("shapley"),
    )

"""Near-duplicate groups by MinHash with tensored banding, confirmed on full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, components, dropped, flat, mix, parts, shingles, signed, staged, words

#: Half-bands in each of the two collections, and minhashes in a half-band. A table key is a pair of half-bands, one of
#: each collection: HALVES ** 2 tables of 2 * ROWS minhashes from 2 * HALVES * ROWS minhashes (64 tables from 48, not 384).
HALVES, ROWS = 8, 3

#: Bits of a set's parity map: bit k is set if an odd number of its shingles hash to k.
PARITY_BITS = 1024
#: A class of exact copies with more than this share of all rows is hot; there are fewer than HOT_CLASSES of them.
HOT_CLASSES = 1000

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 63, 2 * HALVES * ROWS, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, 2 * HALVES * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def half_bands(sh: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(documents with shingles, 2 * HALVES) half-band keys."""
    starts = at[:-1][np.diff(at) > 0]
    out = np.zeros((len(starts), 2 * HALVES), np.uint64)
    for k in range(2 * HALVES):
        key = np.full(len(starts), np.uint64(k + 1))
        for r in range(k * ROWS, (k + 1) * ROWS):
            key = mix(key + np.minimum.reduceat((sh ^ _XOR[r]) * _ODD[r], starts))
        out[:, k] = key
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, set_a, set_b, half array<bigint>): set_a and set_b name the set, half has its half-band keys."""
    schema = f"{id_col} bigint, n_shingles bigint, set_a bigint, set_b bigint, half array<bigint>"

    def run(batches):
        for batch in parts(batches):
            data, at = flat(batch.column(1))
            for i, j in chunks(at):
                part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
                h, row, _, _ = words(part, own)
                sh, ends = shingles(h, row, j - i)
                n = np.diff(ends)
                has = n > 0
                half, names = np.zeros((j - i, 2 * HALVES), np.uint64), np.zeros((j - i, 2), np.uint64)
                if has.any():
                    half[has] = half_bands(sh, ends)
                    starts = ends[:-1][has]
                    names[has, 0] = np.add.reduceat(mix(sh + np.uint64(77)), starts)
                    names[has, 1] = np.add.reduceat(mix(sh ^ np.uint64(0xABCDEF)), starts)
                offsets = np.concatenate(([0], np.cumsum(has * 2 * HALVES))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(half[has].ravel())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(n), pa.array(signed(names[:, 0])), pa.array(signed(names[:, 1])), lists],
                    [id_col, "n_shingles", "set_a", "set_b", "half"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def parity_map(sh: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """(rows, PARITY_BITS / 64) parity maps; two of them differ in at most as many bits as their sets in shingles."""
    out = np.zeros((n_rows, PARITY_BITS // 64), np.uint64)
    at = mix(sh ^ np.uint64(0x5DEECE66D)) % np.uint64(PARITY_BITS)
    np.bitwise_xor.at(out, (row, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
    return out


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, set, parity): sorted distinct shingle hashes as bytes, and the parity map."""

    def run(batches):
        for batch in parts(batches):
            data, at = flat(batch.column(1))
            for i, j in chunks(at):
                h, row, _, _ = words(data[at[i] : at[j]], at[i : j + 1] - at[i])
                sh, ends = shingles(h, row, j - i)
                some = [sh[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                bits = parity_map(sh, np.repeat(np.arange(j - i), np.diff(ends)), j - i)
                maps = pa.FixedSizeListArray.from_arrays(pa.array(signed(bits.ravel())), PARITY_BITS // 64).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(some, pa.binary()), maps], [id_col, "set", "parity"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} bigint, set binary, parity array<bigint>")


def confirm(edges: DataFrame, sets: DataFrame, id_col: str, percent: int) -> DataFrame:
    """(a, b, linked) for candidate pairs (a, b), by the intersection of their full sets."""
    with_a = edges.join(sets.select(F.col(id_col).alias("a"), F.col("set").alias("set_of_a")), "a")
    with_b = with_a.join(sets.select(F.col(id_col).alias("b"), F.col("set").alias("set_of_b")), "b")

    def run(batches):
        for batch in parts(batches):
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                least, most = sorted((len(x), len(y)))
                shared = 0
                if 100 * least >= percent * most:
                    at = np.searchsorted(y, x)
                    at[at == len(y)] = 0
                    shared = int((y[at] == x).sum())
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "linked"])

    return with_b.select("a", "b", "set_of_a", "set_of_b").mapInArrow(run, "a bigint, b bigint, linked boolean")


def shared_counts(sets: DataFrame, id_col: str) -> DataFrame:
    """(rep, n, c): size of each set, and how many of its shingles another set has too."""

    def run(batches):
        for batch in parts(batches):
            for k in range(0, batch.num_rows, 200):
                some = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1).slice(k, 200)]
                ids = np.repeat(np.asarray(batch.column(0).slice(k, 200)), [len(x) for x in some])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(some))], ["rep", "s"])

    every = sets.select(id_col, "set").mapInArrow(run, "rep bigint, s bigint")
    twice = every.groupBy("s").agg(F.count("*").alias("m")).filter("m > 1").select("s")
    common = every.join(twice, "s", "left_semi").groupBy("rep").agg(F.count("*").alias("c"))
    sizes = sets.select(F.col(id_col).alias("rep"), (F.length("set") / 8).cast("bigint").alias("n"))
    return sizes.join(common, "rep", "left").select("rep", "n", F.coalesce("c", F.lit(0)).cast("bigint").alias("c"))


def may_link(met: DataFrame, percent: int) -> DataFrame:
    """(key, rep, n, c) without members that cannot be linked inside their bucket.

    Two sets share at most min(c, c') shingles. With any partner of the bucket, of size m or more, a member's similarity is
    at most c / (n + max(m, c) - c); the bound is exact, so no link is lost. Buckets left with one member go too.
    """
    least = met.groupBy("key").agg(F.min("n").alias("m"))
    able = met.join(least, "key").filter(100 * F.col("c") >= percent * (F.col("n") + F.greatest("m", "c") - F.col("c"))).drop("m")
    several = able.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key")
    return able.join(several, "key", "left_semi")


#: Whether table t is the first that both members of a pair share: no smaller half-band of either collection is equal.
_FIRST_TABLE = " and ".join(
    f"not (t div {HALVES} > {k} and half[{k}] = half_p[{k}]) and not (t % {HALVES} > {k} and half[{HALVES + k}] = half_p[{HALVES + k}])" for k in range(HALVES - 1)
)


#: Bits in which the parity maps of a pair differ: no more than the shingles that only one of both has.
_APART = " + ".join(f"bit_count(parity[{k}] ^ parity_p[{k}])" for k in range(PARITY_BITS // 64))


def expanded(docs: DataFrame, classes: DataFrame, n_docs: int) -> DataFrame:
    """Rows of ``docs`` with what ``classes`` (set_a, set_b, n_shingles, copies, ...) says of their set, if anything.

    Classes with a thousandth of all rows or more are broadcast: there are at most a thousand, so that a class with a third of
    all rows is met where its rows lie. The others are shuffled.
    """
    name = ["set_a", "set_b", "n_shingles"]
    hot = F.col("copies") * HOT_CLASSES >= n_docs
    large, small = F.broadcast(classes.filter(hot)), classes.filter(~hot)
    few = docs.join(large.select(*name), name, "left_anti").join(small, name, "left")
    return docs.join(large, name).unionByName(few)


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links), kept (id = component_id).

    Two documents are linked when 100 * |intersection| >= percent * |union| of their sets of distinct five-word shingles
    (A-Z lower-cased; fewer words: the whole sequence is the one shingle; no words, empty or null text: an empty set,
    linked with nothing). Rows without id are left out. Rows of one id are one document: each is
    returned, and the smallest id of what any of them is linked with is its component. Other columns are not read. An empty
    table gives an empty result.

    1. Documents of the same set are one class; only its smallest id goes on.
    2. Tensored banding in two steps: a half-band of the first collection must be shared at all, then the pair of a half-band
       of each collection is the table key.
    3. Members that by the number of their shingles that any other set has cannot reach the similarity leave the bucket; this
       takes most false collisions out before any pair is formed.
    4. A bucket is compared with one pivot, so a group of any size that hangs together costs one comparison a member.
       Buckets that are not one component go on with further pivots, sixteen times as many each round, against members of
       other components only, and each pair only in the first table that both share, until a bucket is one component or all
       its members were pivots. So links between members are found or implied. A pair leaves the join only if the same bound
       and its parity maps let it pass: maps differ in no more bits than the sets in shingles, so near misses, which differ in
       more than the limit, go inside the join and no link is lost.
    5. Candidates are confirmed on the full sets; links become components by label passing in the shared folder.
    """
    docs = docs.filter(F.col(id_col).isNotNull())
    sig = staged(signatures(docs, id_col, text_col), "signatures")
    classes = staged(sig.filter("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min(id_col).alias("rep"), F.count("*").alias("copies")), "classes")
    reps = sig.join(classes.select(F.col("rep").alias(id_col)), id_col, "left_semi").select(F.col(id_col).alias("rep"), "half").dropDuplicates(["rep"])

    first = reps.select("rep", F.posexplode(F.slice("half", 1, HALVES)).alias("i", "key"))
    shared = first.groupBy("i", "key").agg(F.count("*").alias("n")).filter("n > 1").select("i", "key")
    alive = first.join(shared, ["i", "key"], "left_semi").select("rep").distinct()
    pairs = (
        reps.join(alive, "rep", "left_semi")
        .select("rep", "half", F.explode(F.sequence(F.lit(0), F.lit(HALVES * HALVES - 1))).alias("t"))
        .select("rep", "t", F.xxhash64("t", F.expr(f"half[t div {HALVES}]"), F.expr(f"half[{HALVES} + t % {HALVES}]")).alias("key"))
    )
    shared_keys = pairs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    met = staged(pairs.join(shared_keys, "key", "left_semi"), "buckets")

    wanted = met.select(F.col("rep").alias(id_col)).distinct()
    sets = staged(shingle_sets(docs.select(id_col, text_col).join(wanted, id_col, "left_semi"), id_col, text_col).dropDuplicates([id_col]), "sets")
    sized = staged(shared_counts(sets, id_col), "sizes")
    members = staged(may_link(met.join(sized, "rep"), percent), "members")

    # the first pivot of a bucket: the member with the largest share of shingles that others have too
    first_pivot = members.groupBy("key").agg(F.max_by("rep", F.struct(F.col("c") / F.col("n"), -F.col("rep"))).alias("p"))
    edges = members.join(first_pivot, "key").filter("rep <> p").select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b")).distinct()
    tested = staged(confirm(edges, sets, id_col, percent), "tested")
    # a representative is met with its label once, not once for each of its buckets
    of_rep = staged(members.groupBy("rep", "n", "c").agg(F.collect_list(F.struct("key", "t")).alias("buckets")), "of_rep")
    halves, maps = reps.select("rep", "half"), sets.select(F.col(id_col).alias("rep"), "parity")
    done, pivots, left = 0, 4, None
    while True:
        if left is None:  # there are new links
            labels = components(tested.filter("linked"))
            named = of_rep.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
            placed = named.select(F.inline("buckets"), "rep", "n", "c", "label")
            mixed = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
            ranked = placed.join(mixed, "key").withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(F.desc(F.expr("c / n")), "rep")))
            left = staged(ranked.join(halves, "rep").join(maps, "rep"), "mixed")
            longest = left.agg(F.max("rank")).first()[0] or 0
        # the last of a bucket has been compared with all before it
        if done + 1 >= longest:
            break
        chosen = left.filter((F.col("rank") > done) & (F.col("rank") <= pivots)).select("key", *[F.col(c).alias(f"{c}_p") for c in ("rep", "label", "n", "c", "rank", "half", "parity")])
        low = F.least("c", "c_p")
        fits = (F.col("label") != F.col("label_p")) & (F.col("rank") > F.col("rank_p")) & (100 * low >= percent * (F.col("n") + F.col("n_p") - low))
        tries = (
            left.join(chosen, "key")
            .filter(fits & F.expr(_FIRST_TABLE) & (F.expr(_APART) * (100 + percent) <= (F.col("n") + F.col("n_p")) * (100 - percent)))
            .select(F.least("rep", "rep_p").alias("a"), F.greatest("rep", "rep_p").alias("b"))
            .join(tested.select("a", "b"), ["a", "b"], "left_anti")
        )
        more = staged(confirm(tries, sets, id_col, percent), "tested")
        tested = tested.unionByName(more)
        if not more.filter("linked").isEmpty():
            left = None
        done, pivots = pivots, pivots * 16
    of_class = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("set_a", "set_b", "n_shingles", "copies", F.coalesce("label", "rep").alias("component_id"))
    rows = expanded(sig.select(id_col, "set_a", "set_b", "n_shingles"), of_class, sig.count())
    return rows.select(id_col, "n_shingles", F.coalesce("component_id", F.col(id_col)).alias("component_id")).withColumn("kept", F.col(id_col) == F.col("component_id"))

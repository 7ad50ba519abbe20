"""Helpers of the operators: flat byte views of texts, word hashes, blocks of documents, staged tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Bytes of text that numpy code works on at once; its temporaries take about a hundred times as much.
CHUNK_BYTES = 1 << 18
#: Rows that are taken out of an Arrow batch at once.
PART_ROWS = 500

_P = np.uint64(0x9E3779B97F4A7C15)
_PI = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_tables: dict[str, np.ndarray] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, what: str, by: str | None = None) -> DataFrame:
    """Write to the shared folder, a folder for each value of ``by``, and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=by)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_in = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove what ``staged`` wrote for tables that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# ---- flat views ------------------------------------------------------------------------------------------------------


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column one after the other, and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def parts(batches) -> Iterator:
    """Arrow batches in slices of ``PART_ROWS`` rows, so that copies of their texts stay small."""
    for batch in batches:
        for k in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(k, PART_ROWS)


def chunks(at: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text is a range of its own."""
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, end
        row = end


def _grown(name: str, factor: np.uint64, n: int) -> np.ndarray:
    if name not in _tables or len(_tables[name]) < n:
        table = np.full(max(n, 1 << 20), factor, np.uint64)
        table[0] = 1
        _tables[name] = np.multiply.accumulate(table)
    return _tables[name][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` reads the hash of any span off them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _grown("p", _P, len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [begin, end): equal bytes give equal values wherever they stand."""
    return mix((sums[end] - sums[begin]) * _grown("i", _PI, len(sums))[begin] + (end - begin).astype(np.uint64))


def words(data: np.ndarray, at: np.ndarray, lower: bool = True, inside: np.ndarray = ~_SPACE):
    """Hash, row, begin and end of every word: a run of bytes of the class ``inside``, ``[^\\x20\\x09-\\x0D]`` if not given."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    inner = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.concatenate(([False], inner[:-1]))
    after = np.concatenate((inner[1:], [False]))
    begin = np.flatnonzero(inner & (~before | edge[:-1]))
    end = np.flatnonzero(inner & (~after | edge[1:])) + 1
    h = span_hash(prefix_hash(_LOWER[data] if lower else data), begin, end)
    return h, np.searchsorted(at, begin, "right") - 1, begin, end


def shingles(h: np.ndarray, row: np.ndarray, n_rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and n_rows + 1 offsets; fewer words than ``size`` make one shingle."""
    factors = _grown("p", _P, size + 1)
    n_words = np.bincount(row, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(n_words)))
    out_h, out_row = [], []
    if len(h) >= size:
        s = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            s += h[k : len(h) - size + 1 + k] * factors[k]
        same = row[: len(s)] == row[size - 1 :]
        out_h.append(mix(s[same]))
        out_row.append(row[: len(s)][same])
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        s = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = n_words[short] > k
            s[has] += h[first[short[has]] + k] * factors[k]
        out_h.append(mix(s + n_words[short].astype(np.uint64)))
        out_row.append(short)
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(n_rows + 1, np.int64)
    sh, sr = np.concatenate(out_h), np.concatenate(out_row)
    order = np.lexsort((sh, sr))
    sh, sr = sh[order], sr[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (sr[1:] != sr[:-1])
    sh, sr = sh[new], sr[new]
    return sh, np.concatenate(([0], np.cumsum(np.bincount(sr, minlength=n_rows))))


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


# ---- blocks ----------------------------------------------------------------------------------------------------------


def in_blocks(docs: DataFrame, key: str, text: str, block_bytes: int = 4 << 20) -> DataFrame:
    """(block, key, text): documents dealt by the hash of their key into blocks of about ``block_bytes`` of text.

    The number of blocks follows the total size, so a block stays as small on any table.
    """
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n = total // block_bytes + 1
    return docs.select(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(n)).alias("block"), F.col(key), F.col(text))


# ---- components ------------------------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``links`` (a, b); the label is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label's own label,
    so that long chains shrink by half a round. Rounds are written to the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = staged(both, "links")
    before = state = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (
            both.join(state.withColumnRenamed("node", "b").withColumnRenamed("label", "of_b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("of_b").alias("m"))
        )
        stepped = state.join(near, "node").select("node", "label", F.least("label", "m").alias("low"))
        # the label's own label, taken from the state before this step
        parent = state.select(F.col("node").alias("low"), F.col("label").alias("up"))
        jumped = stepped.join(parent, "low", "left").select(
            "node", F.coalesce(F.least("low", "up"), "low").alias("label"), (F.coalesce(F.least("low", "up"), "low") != F.col("label")).alias("moved")
        )
        jumped = staged(jumped, "labels")
        dropped(before)
        before, state = jumped, jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            dropped(both)
            return state

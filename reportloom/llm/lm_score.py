"""Stupid-backoff scores of documents from n-gram count tables partitioned by hash."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, in_blocks, mix, words

#: About so many bytes of text stand for one count bucket; a bucket holds the distinct n-grams of each block that fall to it.
BUCKET_BYTES = 16 << 20
_FIELDS = "block bigint, bucket bigint, grams binary, counts binary"


def _grams(data: np.ndarray, at: np.ndarray, order: int):
    """For every word: the hash of each n-gram that ends there (0 where the document has too few words before it), and its row."""
    h, row, _, _ = words(data, at)
    ends = [mix(h + np.uint64(1))]
    for n in range(2, order + 1):
        g = np.zeros(len(h), np.uint64)
        if len(h) >= n:
            own = row[n - 1 :] == row[: len(h) - n + 1]
            g[n - 1 :] = np.where(own, mix(ends[-1][n - 2 : -1] * np.uint64(0x100000001B3) + h[n - 1 :] + np.uint64(n)), np.uint64(0))
        ends.append(g)
    return ends, row


def _table(data: np.ndarray, at: np.ndarray, order: int):
    """Distinct n-grams of a block in hash order, how often each stands in it, and the place of every word's n-grams."""
    ends, row = _grams(data, at, order)
    every = np.concatenate(ends) if ends else np.zeros(0, np.uint64)
    table, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    if len(table) and table[0] == 0:
        counts[0] = 0
    return table, counts, place.reshape(order, -1), row


def _cuts(table: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are equal ranges of the hash."""
    edges = (np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets)) if buckets > 1 else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(table, edges), [len(table)]))


def score(docs: DataFrame, order: int = 2, backoff: float = 0.4, min_count: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, log_score (natural log, summed over its words), per_word (null without words).

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased. Counts are taken over all documents. Higher orders keep n-grams
    of ``min_count`` and more, as pruned tables do. S(w | v) = c(v w) / c(v) if c(v w) is kept, else backoff * S(w | v
    without its first word); at the end c(w) / N. Empty and null text: no words, score 0. Repeated rows are documents of
    their own, a null id is an id; other columns are not read; an empty table gives an empty result.

    Documents lie in blocks of a few MB. A block sends each distinct n-gram once with its count, to the bucket of its
    hash; the bucket's table adds them up and answers each block with the totals, in the block's order; the block joins
    them to its exploded n-grams and sums per document. A frequent n-gram is one entry per block wherever it occurs, so
    no bucket is hot, and what travels is distinct n-grams per block, never one row per word.
    """
    blocks = in_blocks(docs, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    buckets = int(total // BUCKET_BYTES + 1)

    def emit(key, table):
        data, at = flat(table.column(2))
        grams, counts, _, _ = _table(data, at, order)
        cuts = _cuts(grams, buckets)
        some = np.flatnonzero(np.diff(cuts))
        small = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32)
        return pa.table(
            {
                "block": pa.array(np.full(len(some), key[0].as_py(), np.int64)),
                "bucket": pa.array(some.astype(np.int64)),
                "grams": pa.array([grams[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
                "counts": pa.array([_pack(small[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
            }
        )

    def add_up(key, frame):
        grams = [np.frombuffer(x, np.uint64) for x in frame.grams]
        counts = np.concatenate([_unpack(x, len(g)) for x, g in zip(frame.counts, grams)]) if grams else np.zeros(0)
        _, place = np.unique(np.concatenate(grams), return_inverse=True)
        sums = np.bincount(place, weights=counts)[place].astype(np.uint64)
        cut = np.cumsum([len(g) for g in grams])[:-1]
        return pd.DataFrame({"block": frame.block, "bucket": frame.bucket, "grams": b"", "counts": [_pack(x) for x in np.split(sums, cut)]})

    sent = blocks.groupBy("block").applyInArrow(emit, _FIELDS)
    totals = sent.groupBy("bucket").applyInPandas(add_up, _FIELDS)
    n_words = sent_words(blocks, text_col)
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words bigint, log_score double, per_word double"

    def finish(key, left, right):
        data, at = flat(left.column(2))
        n = len(at) - 1
        grams, _, place, row = _table(data, at, order)
        cuts = _cuts(grams, buckets)
        all_counts = np.zeros(len(grams), np.float64)
        for b, packed in zip(right.column("bucket").to_pylist(), right.column("counts").to_pylist()):
            all_counts[cuts[b] : cuts[b + 1]] = _unpack(packed, cuts[b + 1] - cuts[b])
        if len(grams) and grams[0] == 0:
            all_counts[0] = 0
        logs = np.log(np.maximum(all_counts, 1))
        if len(row):
            own = logs[place[0]] - np.log(n_words)
            for k in range(1, order):
                seen = all_counts[place[k]] >= min_count
                context = np.concatenate(([0], place[k - 1][:-1]))
                has = grams[place[k]] != 0
                own = np.where(seen, logs[place[k]] - logs[context], np.where(has, own + np.log(backoff), own))
        else:
            own = np.zeros(0)
        sums, words_of = np.bincount(row, weights=own, minlength=n), np.bincount(row, minlength=n)
        with np.errstate(invalid="ignore"):
            mean = np.where(words_of > 0, sums / words_of, np.nan)
        return pa.table(
            {id_col: left.column(1), "n_words": pa.array(words_of.astype(np.int64)), "log_score": pa.array(sums), "per_word": pa.array(mean, mask=words_of == 0)}
        )

    return blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(finish, schema)


def sent_words(blocks: DataFrame, text_col: str) -> int:
    """Number of words in all documents, counted over whole texts."""
    low = F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"))
    return int(blocks.agg(F.sum(low).alias("n")).first()["n"] or 0)


def _pack(values: np.ndarray) -> bytes:
    """Counts as bytes; those from 255 up follow as 64-bit integers."""
    small = np.minimum(values, 255).astype(np.uint8)
    return small.tobytes() + values[small == 255].astype(np.uint64).tobytes()


def _unpack(packed: bytes, n: int) -> np.ndarray:
    small = np.frombuffer(packed, np.uint8, n)
    out = small.astype(np.float64)
    out[small == 255] = np.frombuffer(packed[n:], np.uint64).astype(np.float64)
    return out

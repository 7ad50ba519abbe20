"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, use: Column, rows: int, most_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """Up to ``rows`` labelled documents of up to ``most_bytes`` bytes, for training only: (id, text, label).

    The choice is by a hash of the id, so it is the same in each run. A document with labels of both kinds has the larger.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & use)
        .groupBy(id_col)
        .agg(F.max(label).cast("int").alias("label__"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(rows)
    )
    short = docs.filter(F.octet_length(F.coalesce(text_col, F.lit(""))) <= most_bytes).select(id_col, text_col)
    # at most ``rows`` rows of two numbers
    return short.join(F.broadcast(chosen), id_col).select(id_col, text_col, F.col("label__").alias(label))

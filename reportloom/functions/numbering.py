"""Row numbers and running sums over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import shared_dir

_ROW = "_row"
_PART = "_part"


def _sorted_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    """Globally sorted and numbered inside each partition, then checkpointed.

    The checkpoint pins partition borders: a lost executor may not recompute
    them differently. ``order`` must end in a unique column.
    """
    shared_dir(df.sparkSession)
    marked = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    return (
        marked.withColumn(_PART, F.shiftrightunsigned("_id", 33))
        .withColumn(_ROW, F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
        .checkpoint()
    )


def _offsets(per_part: DataFrame, sums: list[str]) -> DataFrame:
    """Sums over all earlier partitions; one row per partition goes in."""
    before = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums]
    return per_part.select(_PART, *cols)


def with_row_number(df: DataFrame, order: list[Column], out: str = "rn") -> DataFrame:
    """A 1-based number in the given order, one sort and no further shuffle of the rows."""
    parts = _sorted_parts(df, order)
    counts = parts.groupBy(_PART).agg(F.count("*").alias("n"))
    # one row per sort partition: as small as spark.sql.shuffle.partitions
    offsets = F.broadcast(_offsets(counts, ["n"]))
    return (
        parts.join(offsets, _PART)
        .withColumn(out, F.col("n_before") + F.col(_ROW) + 1)
        .drop(_PART, _ROW, "n_before")
    )


def with_running_sums(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Add running totals ``{out: column}`` in the given order."""
    parts = _sorted_parts(df, order)
    totals = parts.groupBy(_PART).agg(*[F.sum(c).alias(out) for out, c in sums.items()])
    offsets = F.broadcast(_offsets(totals, list(sums)))
    here = W.partitionBy(_PART).orderBy(_ROW).rowsBetween(W.unboundedPreceding, 0)
    joined = parts.join(offsets, _PART)
    cols = {out: F.sum(c).over(here) + F.col(f"{out}_before") for out, c in sums.items()}
    return joined.withColumns(cols).drop(_PART, _ROW, *[f"{out}_before" for out in sums])

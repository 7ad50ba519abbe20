"""Many rows of a key in one row, on tables and on streams."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Rows of one block at most.
BLOCK_ROWS = 10_000


def blocks(rows: DataFrame, by: list[str], name: str, most: int = BLOCK_ROWS) -> DataFrame:
    """The columns ``by``, and the others of up to ``most`` rows with equal values there as an array ``name``.

    On a stream these are the rows of one micro-batch: an aggregate would keep
    them until its watermark has passed. No task holds more than an Arrow batch.
    """
    inner = [c for c in rows.columns if c not in by]
    # what comes from Arrow may be null
    field = lambda c: T.StructField(c, rows.schema[c].dataType)
    folded_type = T.ArrayType(T.StructType([field(c) for c in inner]))
    schema = T.StructType([*(field(c) for c in by), T.StructField(name, folded_type)])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                part = whole.slice(at, most)
                folded = pa.StructArray.from_arrays([part.column(c) for c in inner], inner)
                lists = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), folded)
                yield pa.RecordBatch.from_arrays([*(part.column(c).slice(0, 1) for c in by), lists], [*by, name])

    return rows.groupBy(*by).applyInArrow(fold, schema)

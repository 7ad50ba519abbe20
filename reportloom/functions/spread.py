"""Use all cores on tables that come in few files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, key: str, tasks: int | None) -> DataFrame:
    """Deal the rows out to ``tasks`` tasks by ``key``; with None the rows stay as they were read.

    Title work is heavy on CPU and light on bytes, so one narrow shuffle pays
    for a table of one file. The caller knows its tables: one of more files than
    cores is best left alone.
    """
    return df.repartition(tasks, key) if tasks else df

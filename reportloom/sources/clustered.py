"""A layout for lookups by id: files of disjoint id ranges, and a small table of what each file holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, key: str, files: int) -> None:
    """Store rows in ``files`` ranges of ``key``, sorted inside, with the least and greatest key of every file beside them.

    Sorted rows give row groups narrow key ranges too, so a filter on the key
    skips inside a file as well. Rows without key are kept in a file of their own range.
    """
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    zones = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("least"), F.max(key).alias("greatest"))
    zones.coalesce(1).write.parquet(f"{path}/zones")


def files_with(spark: SparkSession, path: str, ids: DataFrame, key: str) -> list[str]:
    """The files whose range holds any of the ids; at most as many as were written."""
    zones = spark.read.parquet(f"{path}/zones")
    return [r["file"] for r in _zones_of(zones, ids, key).select("file").distinct().collect()]


def _zones_of(zones: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The zones of the ids. Every id looks into one list, which has as many entries as there are files."""
    asked = ids.select(F.col(key).alias("id")).where("id is not null").distinct()
    listed = zones.where("least is not null").agg(F.collect_list(F.struct("least", "greatest", "file")).alias("z"))
    held = F.filter("z", lambda z: (z["least"] <= F.col("id")) & (F.col("id") <= z["greatest"]))
    return asked.join(F.broadcast(listed)).select(F.explode(held).alias("h")).select("h.file")


def read_by_keys(spark: SparkSession, path: str, ids: DataFrame, key: str) -> DataFrame:
    """The stored rows of the asked ids; only the files that may hold them are opened."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_with(spark, path, ids, key)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).join(ids.select(key).distinct(), key, "left_semi")

"""The jobs as Structured Streaming queries.

New rows are found by the source's own checkpoint, so a row is enriched exactly
once and a restart goes on where it stopped. Dictionaries are read when a query
starts and stay fixed while it runs.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import candidates as C
from ..operators import matching as M
from ..operators import merging as U
from ..sources.snapshots import among

# Seconds between polls.
POLL_SECONDS = 30

Enrich = Callable[[DataFrame], DataFrame]

#: Column of the text of a record that does not parse, and of the file it came from.
CORRUPT, SOURCE = "corrupt_record", "source_file"
LOG = "batch bigint, n_rows bigint, enriched bigint, skipped bigint, errors bigint, micros bigint"


def file_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", name_glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """Files that arrive in a folder; ``files_per_trigger`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_corrupt(schema: str | T.StructType) -> T.StructType:
    """The schema with the column that takes records which do not parse."""
    known = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return T.StructType([*known.fields, T.StructField(CORRUPT, T.StringType())])


def record_stream(spark: SparkSession, path: str, schema: str | T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines that arrive in a folder; a line that does not parse is a row too, with its text and its file."""
    reader = spark.readStream.schema(with_corrupt(schema)).format("json")
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias(SOURCE))


def _start(writer, checkpoint: str, every: int | None) -> StreamingQuery:
    """Poll every ``every`` seconds, or work off what is there and stop."""
    trigger = {"processingTime": f"{every} seconds"} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _dealt(df: DataFrame, tasks: int | None, key: str = "report_id") -> DataFrame:
    """A micro-batch of few files is dealt out to ``tasks`` tasks by its key; records that do not parse have none and go by their text."""
    by = [c for c in (key, CORRUPT) if c in df.columns]
    return df.repartition(tasks, *by) if tasks else df


def _by_batch(
    stream: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, partition_by: str | None = None, log: str | None = None
):
    """Each micro-batch writes what ``make`` gives for it to a folder of its own, and overwrites that when it is run again.

    ``make`` sees a table, not a stream, so it may join and group freely: any form of a dictionary works. With ``log``
    the batch also leaves a row of outcome counts and its duration; they are taken by the write itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        began, seen = time.monotonic(), Observation()
        done = make(batch)
        writer = (U.observed_outcomes(done, seen) if log else done).write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{path}/batch={number}")
        if log:
            counts = seen.get
            row = (number, *[counts[c] for c in U.OUTCOMES], int((time.monotonic() - began) * 1_000_000))
            batch.sparkSession.createDataFrame([row], LOG).coalesce(1).write.mode("overwrite").parquet(f"{log}/of={number}")

    return stream.writeStream.foreachBatch(write)


def batch_log(spark: SparkSession, log: str) -> DataFrame:
    """What the batches of a stream left in ``log``; the input of ``quality.throughput_log``."""
    return spark.read.schema(f"{LOG}, of int").parquet(log).drop("of")


def stream_enrich(
    reports: DataFrame,
    enrich: Enrich,
    path: str,
    checkpoint: str,
    every: int | None = POLL_SECONDS,
    tasks: int | None = None,
    log: str | None = None,
) -> StreamingQuery:
    """Enrich the untagged titled reports of a stream, a folder per micro-batch; ``log`` names a folder for ``batch_log``."""
    pending = reports.where(C.untagged(F.col("tags")) & C.titled(F.col("article_title")))
    return _start(_by_batch(pending, lambda batch: enrich(_dealt(batch, tasks)), path, log=log), checkpoint, every)


def stream_on_arrival(
    keys: DataFrame,
    reports: DataFrame,
    enrich: Enrich,
    path: str,
    checkpoint: str,
    every: int | None = POLL_SECONDS,
    tasks: int | None = None,
    month: str | None = None,
) -> StreamingQuery:
    """Enrich the stored reports whose keys arrive on a stream.

    With ``month``, a partition column that both sides have, a micro-batch reads
    the months it names and no others: the names, as many as there are months,
    become a partition filter of the scan.
    """
    on = ["key", month] if month else ["key"]
    titled = reports.where(C.titled(F.col("article_title"))).select(*on, "report_id", "firm_nm", "article_title")

    def arrived(batch: DataFrame) -> DataFrame:
        stored = titled
        if month:
            stored = titled.where(among(F.col(month), [r[0] for r in batch.select(month).distinct().collect()]))
            same = (F.col("k.key") == F.col("s.key")) & F.col(f"k.{month}").eqNullSafe(F.col(f"s.{month}"))
            return enrich(_dealt(batch.select(*on).alias("k").join(stored.alias("s"), same).select("s.*"), tasks))
        return enrich(_dealt(batch.join(stored, on), tasks))

    return _start(_by_batch(keys, arrived, path), checkpoint, every)


def stream_match(
    reports: DataFrame, summaries: DataFrame, path: str, checkpoint: str, every: int | None = POLL_SECONDS, **options
) -> StreamingQuery:
    """Match each micro-batch of reports against the summary table; see ``stream_match_late`` for summaries that come later.

    A batch writes its own folder and overwrites it when it is run again. It is
    used twice, for titles and for writers, and kept meanwhile.
    """

    def match(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        M.match_summaries(batch, summaries, **options).write.mode("overwrite").parquet(f"{path}/batch={number}")
        batch.unpersist()

    return _start(reports.writeStream.foreachBatch(match), checkpoint, every)


def stream_match_late(
    summaries: DataFrame, reports: DataFrame, path: str, checkpoint: str, every: int | None = POLL_SECONDS, **options
) -> StreamingQuery:
    """Match the stored, still unlinked reports against each micro-batch of summaries.

    Together with ``stream_match`` every pair is met, whichever side comes first.
    """
    return _start(_by_batch(summaries, lambda batch: M.match_summaries(reports, batch, **options), path), checkpoint, every)


def stream_match_interval(
    reports: DataFrame, summaries: DataFrame, path: str, checkpoint: str, every: int | None = POLL_SECONDS, late_days: int = 30
) -> StreamingQuery:
    """Join a stream of reports and a stream of summaries, whichever side comes first.

    No report or summary is read again: both sides wait in state under (firm,
    report day), a summary under each of the nine days it may fit, the rows of a
    micro-batch and key folded to blocks. A day leaves the state once both
    streams have passed it by ``late_days``; blocks that come later than that are
    dropped here, counted in the progress of the query, and left to
    ``matching.match_backlog``. A micro-batch writes, for each report that met a
    fitting summary in it, the best of them and their number ``n_fitting``;
    ``matching.best_pairs`` makes matches of these.
    """
    # it needs pyarrow, which the other jobs do not
    from ..functions import blocks as B

    spark, key = reports.sparkSession, ["firm", "day_at"]
    firm_day = lambda df: df.withColumn("day_at", F.date_from_unix_date("day").cast("timestamp")).drop("day")
    left = B.blocks(firm_day(M.report_side(reports).where("day is not null")), key, "reports").withWatermark("day_at", f"{late_days} days")
    # the last of the days of a summary is ahead of the first by the whole interval
    behind = late_days + M.MOST_GAP - M.LEAST_GAP
    right = B.blocks(firm_day(M.summary_days(summaries)), key, "summaries").withWatermark("day_at", f"{behind} days")
    met = left.alias("r").join(right.alias("s"), (F.col("r.firm") == F.col("s.firm")) & (F.col("r.day_at") == F.col("s.day_at")))
    meetings = met.select("r.firm", "r.reports", "s.summaries")

    def match(batch: DataFrame, number: int) -> None:
        # read several times; readers of the results pass over the folder, and the next batch overwrites it
        numbered, folder = batch.withColumn("meeting", F.monotonically_increasing_id()), f"{path}/_met"
        numbered.write.mode("overwrite").parquet(folder)
        stored = spark.read.schema(numbered.schema).parquet(folder)
        M.best_of_meetings(stored).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(meetings.writeStream.foreachBatch(match), checkpoint, every)


def stream_isolation(
    reports: DataFrame,
    enrich: Enrich,
    path: str,
    checkpoint: str,
    every: int | None = POLL_SECONDS,
    tasks: int | None = None,
) -> StreamingQuery:
    """Rows that cannot be processed go to ``route=quarantine`` of their batch, the others to ``route=good``.

    Over a ``record_stream`` these are also the records that do not parse. They
    keep their text and their file, and ``replayed`` takes them up again.
    """
    return _start(_by_batch(reports, lambda batch: _routed(enrich(_dealt(batch, tasks))), path, "route"), checkpoint, every)


def _routed(done: DataFrame) -> DataFrame:
    good = F.col("enriched.status") == "success"
    if CORRUPT in done.columns:
        good = F.col(CORRUPT).isNull() & good
        reason = F.when(F.col(CORRUPT).isNotNull(), "not a record").when(~good, F.col("enriched.note"))
        done = done.withColumn("reason", reason)
    return done.withColumn("route", F.when(good, "good").otherwise("quarantine"))


def replayed(
    quarantine: DataFrame,
    schema: str | T.StructType,
    repair: Callable[[Column], Column],
    enrich: Enrich,
    tasks: int | None = None,
) -> DataFrame:
    """Quarantined records of a ``record_stream`` after ``repair`` of their text, routed like new ones.

    Their files are small for the work they mean; ``tasks`` deals them out as a micro-batch is.
    """
    torn = quarantine.where(F.col(CORRUPT).isNotNull()).select(repair(F.col(CORRUPT)).alias("text"), SOURCE)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = torn.select(F.from_json("text", with_corrupt(schema), options).alias("r"), SOURCE)
    return _routed(enrich(_dealt(read.select("r.*", SOURCE), tasks)))

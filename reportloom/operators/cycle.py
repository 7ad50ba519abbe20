"""One enrichment cycle over stored tables: select, enrich, merge into the touched months, remember."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.snapshots import Snapshots, among, read_if_there
from . import candidates as C
from . import enrich as N
from . import merging as U
from . import quality as V

LEDGER = "report_id bigint, rule_version string, enriched_at timestamp"
MONTH = "reg_month"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty before the first cycle; a ledger that is there and cannot be read is a fault."""
    return read_if_there(spark, path, LEDGER)


def _updates(
    reports: DataFrame, ledger: DataFrame, enrich: Callable[[DataFrame], DataFrame], rule_version: str, n: int | None, work: str
) -> tuple[DataFrame, dict[str, int]]:
    """The enrichment of what is pending, with the month of each report, written once; and its outcome counts."""
    pending = C.pending_reports(reports, n, ledger, rule_version, keep=(MONTH,))
    seen = Observation()
    counted = U.observed_outcomes(enrich(pending), seen)
    counted.select("report_id", MONTH, *[f"enriched.{c}" for c in N.TAG_COLUMNS + N.PREMIUM_COLUMNS]).write.parquet(f"{work}/updates")
    return reports.sparkSession.read.parquet(f"{work}/updates"), dict(seen.get)


def run_cycle(
    spark: SparkSession,
    reports_path: str,
    ledger_path: str,
    enrich: Callable[[DataFrame], DataFrame],
    rule_version: str,
    n: int | None = None,
) -> int:
    """Enrich what this rule version has not seen and store it; gives the number of rows processed.

    The reports are parquet by ``reg_month``. The enrichment is written to the
    shared folder first, and the months it touches are read from there; only
    these are read, merged and replaced, so the cost follows the new rows and
    not the table. The ledger is written last: a cycle that breaks off is done
    again with the same result, and rows that stay empty are not taken twice.
    Reports without a date are a month of their own, the null partition.
    """
    work = f"{shared_dir(spark)}/cycle-{uuid.uuid4().hex}"
    reports = spark.read.parquet(reports_path)
    updates, _ = _updates(reports, read_ledger(spark, ledger_path), enrich, rule_version, n, work)
    # as many values as there are months
    touched = [r[MONTH] for r in updates.select(MONTH).distinct().collect()]
    if not touched:
        return 0
    merged = U.apply_enrichment(reports.where(among(F.col(MONTH), touched)), updates.drop(MONTH))
    merged.write.parquet(f"{work}/merged")
    merged = spark.read.schema(merged.schema).parquet(f"{work}/merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(reports_path)
    # only what the merged rows hold counts as processed
    stored = updates.join(merged.select("report_id"), "report_id", "left_semi")
    U.processed_ledger(stored, rule_version).write.mode("append").parquet(ledger_path)
    return stored.count()


#: Tables of a published store, and the column that each is published by.
STORE = {"reports": MONTH, "ledger": "cycle", "coverage": MONTH, "tag_counts": MONTH}


def open_store(spark: SparkSession, path: str) -> Snapshots:
    return Snapshots(spark, path, STORE)


def _derived(reports: DataFrame) -> dict[str, DataFrame]:
    return {"coverage": V.month_coverage(reports, MONTH), "tag_counts": V.month_tags(reports, MONTH)}


def fill_store(store: Snapshots, reports: DataFrame) -> int:
    """Publish reports that have ``reg_month``, their counts by month and an empty ledger."""
    months = [r[MONTH] for r in reports.select(MONTH).distinct().collect()]
    ledger = store.spark.createDataFrame([], f"{LEDGER}, cycle string")
    return store.publish({"reports": (reports, months), "ledger": (ledger, [])} | {t: (df, months) for t, df in _derived(reports).items()})


def publish_cycle(
    store: Snapshots, enrich: Callable[[DataFrame], DataFrame], rule_version: str, n: int | None = None
) -> dict[str, int]:
    """``run_cycle`` over a published store; gives the counts of the batch, taken while it was written.

    Touched months of the reports, their coverage and tag counts and the ledger
    of this cycle come into force together with one manifest. Whatever happens
    before that leaves the last version as it was, and the cycle is run again.
    Counts of other months are not taken anew.
    """
    spark, work = store.spark, f"{shared_dir(store.spark)}/cycle-{uuid.uuid4().hex}"
    reports, ledger = store.read("reports"), store.read("ledger").drop("cycle")
    updates, counts = _updates(reports, ledger, enrich, rule_version, n, work)
    touched = [r[MONTH] for r in updates.select(MONTH).distinct().collect()]
    if touched:
        merged = U.apply_enrichment(reports.where(among(F.col(MONTH), touched)), updates.drop(MONTH))
        merged.write.parquet(f"{work}/merged")
        merged = spark.read.schema(merged.schema).parquet(f"{work}/merged")
        name = str(store.version() + 1)
        processed = U.processed_ledger(updates, rule_version).withColumn("cycle", F.lit(name))
        store.publish({"reports": (merged, touched), "ledger": (processed, [name])} | {t: (df, touched) for t, df in _derived(merged).items()})
    return counts

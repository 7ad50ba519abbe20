"""Analyst and forecast tables: insert what is new, keep what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import with_row_number, with_running_sums
from .structured import split_analysts


def report_authors(reports: DataFrame, firms: DataFrame) -> DataFrame:
    """(report_id, name, sec_firm_order), one row per analyst of a report."""
    named = reports.select("report_id", "firm_nm", F.explode(split_analysts(F.col("writer"))).alias("name"))
    return named.join(firms, "firm_nm").select("report_id", "name", "sec_firm_order")


def _next_ids(rows: DataFrame, existing: DataFrame, id_column: str, order: list[str]) -> DataFrame:
    """Number new rows on from the highest id in use."""
    highest = existing.agg(F.max(id_column)).scalar()
    numbered = with_row_number(rows, [F.col(c) for c in order])
    return numbered.withColumn(id_column, (F.coalesce(highest, F.lit(0)) + F.col("rn")).cast("bigint")).drop("rn")


def upsert_analysts(reports: DataFrame, firms: DataFrame, analysts: DataFrame) -> DataFrame:
    """Insert-ignore of the distinct (name, firm) pairs; ids follow name and firm."""
    pairs = report_authors(reports, firms).select("name", "sec_firm_order").distinct()
    new = pairs.join(analysts, ["name", "sec_firm_order"], "left_anti")
    added = _next_ids(new, analysts, "analyst_id", ["name", "sec_firm_order"])
    if "created_at" in analysts.columns:
        added = added.withColumn("created_at", F.current_timestamp())
    return analysts.unionByName(added.select(*analysts.columns))


def report_analyst_bridge(reports: DataFrame, firms: DataFrame, analysts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Insert-ignore of (report, analyst) pairs."""
    pairs = (
        report_authors(reports, firms)
        .join(analysts.select("analyst_id", "name", "sec_firm_order"), ["name", "sec_firm_order"])
        .select("report_id", "analyst_id")
        .distinct()
    )
    new = pairs.join(bridge, ["report_id", "analyst_id"], "left_anti")
    if "assigned_at" in bridge.columns:
        new = new.withColumn("assigned_at", F.current_timestamp())
    return bridge.unionByName(new.select(*bridge.columns))


def upsert_forecasts(forecasts: DataFrame, incoming: DataFrame, rank: list[str]) -> DataFrame:
    """Insert-ignore on (report, year); the first row by ``rank`` is kept."""
    values = ["sales", "operating_profit", "net_income"]
    order = F.struct(*rank, *values)
    first = (
        incoming.groupBy("report_id", "year")
        .agg(F.min(order).alias("first"))
        .select("report_id", "year", *[f"first.{v}" for v in values])
    )
    new = first.join(forecasts, ["report_id", "year"], "left_anti")
    added = _next_ids(new, forecasts, "forecast_id", ["report_id", "year"])
    return forecasts.unionByName(added.select(*forecasts.columns))


def analyst_firm_rollup(reports: DataFrame, bridge: DataFrame, analysts: DataFrame) -> DataFrame:
    """Reports and mean price target per analyst and firm."""
    per_analyst = (
        bridge.join(reports.select("report_id", "target_price"), "report_id")
        .groupBy("analyst_id")
        .agg(
            F.count("*").alias("n_reports"),
            F.count("target_price").alias("n_targets"),
            F.sum("target_price").alias("sum_target"),
        )
    )
    return per_analyst.join(analysts, "analyst_id").select(
        "name",
        "sec_firm_order",
        "n_reports",
        "n_targets",
        F.round(F.try_divide("sum_target", "n_targets"), 4).alias("mean_target"),
    )


def forecast_consensus(reports: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Count, mean and exact median of the sales forecasts per ticker and year.

    Equal values are counted first; the median is then read off running counts
    over one global sort, so a ticker with a third of all forecasts is spread
    over as many tasks as its rows need.
    """
    keys = ["ticker", "year"]
    # outer, for otherwise a filter on the tickers is derived and they are computed twice
    tickers = reports.select("report_id", F.explode_outer("stock_tickers").alias("ticker")).where("ticker is not null")
    counted = (
        forecasts.select("report_id", "year", "sales")
        .where("sales is not null")
        .join(tickers, "report_id")
        .groupBy(*keys, "sales")
        .agg(F.count("*").alias("n"))
    )
    order = [F.col(c) for c in (*keys, "sales")]
    running = with_running_sums(counted, order, {"upto": "n"})
    totals = running.groupBy(*keys).agg(
        F.sum("n").alias("n_forecasts"),
        F.sum(F.col("sales") * F.col("n")).alias("sum_sales"),
        F.min(F.col("upto") - F.col("n")).alias("start"),
    )
    place = running.join(totals, keys).withColumns(
        {
            "last": F.col("upto") - F.col("start"),
            "low": F.floor((F.col("n_forecasts") + 1) / 2),
            "high": F.floor(F.col("n_forecasts") / 2) + 1,
        }
    )
    inside = lambda at: (F.col(at) <= F.col("last")) & (F.col(at) > F.col("last") - F.col("n"))
    middle = place.where(inside("low") | inside("high"))
    return middle.groupBy(*keys).agg(
        F.first("n_forecasts").alias("n_forecasts"),
        F.round(F.first(F.col("sum_sales").cast("double") / F.col("n_forecasts")), 4).alias("mean_sales"),
        F.round((F.min("sales") + F.max("sales")).cast("double") / 2, 4).alias("median_sales"),
    )

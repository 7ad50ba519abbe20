"""Schemas, readers and sinks of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIST = T.ArrayType(T.StringType())

REPORTS = T.StructType(
    [
        T.StructField("report_id", T.LongType(), False),
        T.StructField("key", T.StringType()),
        T.StructField("firm_nm", T.StringType()),
        T.StructField("article_title", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("reg_dt", T.StringType()),
        T.StructField("save_time", T.TimestampType()),
        T.StructField("article_url", T.StringType()),
        T.StructField("telegram_url", T.StringType()),
        T.StructField("article_text", T.StringType()),
        T.StructField("linked_summary_id", T.LongType()),
        T.StructField("tags", _LIST),
        T.StructField("stock_names", _LIST),
        T.StructField("sector", T.StringType()),
        T.StructField("target_price", T.LongType()),
        T.StructField("rating", T.StringType()),
        T.StructField("revision_type", T.StringType()),
        T.StructField("report_type", T.StringType()),
        T.StructField("stock_tickers", _LIST),
    ]
)

SUMMARIES = "summary_id bigint, provider string, report_date string, company_name string, author string, pdf_url string"
ANALYSTS = "analyst_id bigint, name string, sec_firm_order int, created_at timestamp"
REPORT_ANALYSTS = "report_id bigint, analyst_id bigint, assigned_at timestamp"
FORECASTS = (
    "forecast_id bigint, report_id bigint, year int, sales decimal(18,2), operating_profit decimal(18,2), "
    "net_income decimal(18,2)"
)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Parquet, ORC, JSON or CSV with a declared schema; parquet may merge added columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "parquet" and schema is None:
        reader = reader.option("mergeSchema", "true")
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    id_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str],
) -> DataFrame:
    """A database table read in id ranges, so that no single task reads it whole."""
    return spark.read.jdbc(
        url, table, column=id_column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=properties
    )


def read_sector_words(spark: SparkSession, path: str) -> DataFrame:
    """(word, sector) rows of a CSV file; of repeated words any one sector is kept."""
    table = read_files(spark, path, "csv", "word string, sector string")
    return table.groupBy("word").agg(F.max("sector").alias("sector"))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A name table for ``entities.lexicon`` from a CSV file of (word, code, sector, searched), in the order of ``rank``.

    ``rank`` is the place of a name among equals; rows with ``searched`` false are looked up but never searched for.
    Of repeated names the first is kept. Names without a code give no ticker.
    """
    table = read_files(spark, path, "csv", "rank int, word string, code string, sector string, searched boolean")
    row = F.struct("rank", "code", "sector", "searched")
    kept = table.where(F.coalesce(F.col("word"), F.lit("")) != "").groupBy("word").agg(F.min(row).alias("row"))
    return kept.select(
        F.when(F.coalesce("row.searched", F.lit(True)), F.col("row.rank")).alias("rank"),
        "word",
        "row.code",
        "row.sector",
        F.when(F.col("row.code").isNotNull(), F.col("row.rank")).alias("ticker_rank"),
    )


def list_from_json(text: Column) -> Column:
    """A JSON array column of a text schema as an array."""
    return F.from_json(text, _LIST)


def write_json_report(df: DataFrame, path: str) -> None:
    """One JSON object per line, arrays as arrays, text unescaped."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_by_month(df: DataFrame, path: str, reg_dt: str = "reg_dt") -> None:
    """Store by month of the report date; only the months in ``df`` are replaced.

    Needs partitionOverwriteMode=dynamic, so that an incremental merge rewrites
    the touched months and leaves the rest of the table alone.
    """
    (
        df.withColumn("reg_month", F.substring(reg_dt, 1, 6))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reg_month")
        .parquet(path)
    )

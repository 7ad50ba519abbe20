"""Keyed updates of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .enrich import PREMIUM_COLUMNS, TAG_COLUMNS

MODEL_COLUMNS = ["tags", "sector", "stock_names", "report_type"]
LIST_COLUMNS = ["tags", "stock_names", "stock_tickers"]
PREMIUM_TYPES = {
    "target_price": "bigint",
    "rating": "string",
    "revision_type": "string",
    "report_type": "string",
    "stock_tickers": "array<string>",
}


def apply_updates(base: DataFrame, updates: DataFrame, columns: list[str], key: str = "report_id") -> DataFrame:
    """Overwrite ``columns`` of the rows named in ``updates``; other rows stay as they are.

    One left join on the key: a small update set is broadcast by its size, a
    large one is shuffled once with the base. Should ``updates`` hold a key more
    than once, the row with the greatest values, in the order of ``columns``, is
    taken, so that no row of the base is doubled; a row without key is ignored.
    """
    one = updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*columns)).alias("_new"))
    new = one.select(key, F.lit(True).alias("_hit"), *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in columns])
    types = {f.name: f.dataType for f in base.schema}

    def pick(c: str):
        if c not in columns:
            return F.col(c)
        return F.when(F.col("_hit"), F.col(f"_new_{c}").cast(types[c])).otherwise(F.col(c)).alias(c)

    return base.join(new, key, "left").select(*[pick(c) for c in base.columns])


def apply_enrichment(reports: DataFrame, updates: DataFrame) -> DataFrame:
    return apply_updates(reports, updates, TAG_COLUMNS + PREMIUM_COLUMNS)


def apply_tags_only(reports: DataFrame, updates: DataFrame) -> DataFrame:
    return apply_updates(reports, updates, TAG_COLUMNS)


def apply_premium_only(reports: DataFrame, updates: DataFrame) -> DataFrame:
    return apply_updates(reports, updates, PREMIUM_COLUMNS)


def apply_model_tags(reports: DataFrame, updates: DataFrame) -> DataFrame:
    return apply_updates(reports, updates, MODEL_COLUMNS)


def apply_article_text(reports: DataFrame, updates: DataFrame) -> DataFrame:
    """Store body texts; a page without text leaves the row as it is."""
    return apply_updates(reports, updates.where("article_text is not null"), ["article_text"])


def schema_adaptive_write(reports: DataFrame, updates: DataFrame) -> DataFrame:
    """All eight columns where the table has them, else the three it always had."""
    wide = "target_price" in reports.columns
    return apply_enrichment(reports, updates) if wide else apply_tags_only(reports, updates)


def add_premium_columns(reports: DataFrame) -> DataFrame:
    """Add the missing premium columns: nulls, and an empty list of tickers."""
    missing = [c for c in PREMIUM_COLUMNS if c not in reports.columns]
    values = {
        c: F.array().cast("array<string>") if c == "stock_tickers" else F.lit(None).cast(PREMIUM_TYPES[c])
        for c in missing
    }
    return reports.withColumns(values) if values else reports


def json_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """List columns as JSON text, for sinks that store text; null becomes ``[]``."""
    cols = [c for c in (columns or LIST_COLUMNS) if c in df.columns]
    empty = F.array().cast("array<string>")
    return df.withColumns({c: F.to_json(F.coalesce(F.col(c), empty)) for c in cols})


def outcome(column: str = "enriched"):
    """enriched: something was found; skipped: nothing was; errors: could not be processed."""
    e = F.col(column)
    something = (F.size(e["tags"]) > 0) | (F.size(e["stock_names"]) > 0) | (e["sector"] != "")
    return F.when(e["status"] != "success", "errors").when(something, "enriched").otherwise("skipped")


OUTCOMES = ("total", "enriched", "skipped", "errors")


def _outcome_counts(column: str):
    state = outcome(column)
    return F.count("*").alias("total"), *[F.count_if(state == s).alias(s) for s in OUTCOMES[1:]]


def batch_outcomes(enriched: DataFrame, column: str = "enriched") -> DataFrame:
    """One row of counts."""
    return enriched.agg(*_outcome_counts(column))


def observed_outcomes(enriched: DataFrame, seen: Observation, column: str = "enriched") -> DataFrame:
    """The same rows; the action that uses them up leaves the counts of ``batch_outcomes`` in ``seen``, without a second run."""
    return enriched.observe(seen, *_outcome_counts(column))


def processed_ledger(updates: DataFrame, rule_version: str) -> DataFrame:
    """What was processed with which rules; feeds ``candidates.not_yet_processed``."""
    return updates.select("report_id", F.lit(rule_version).alias("rule_version"), F.current_timestamp().alias("enriched_at"))

"""Which rows a job works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numbering import with_row_number
from ..functions.text import is_blank

# Firms whose pages hold body text, by URL pattern and rule; aliases.
TEXT_SOURCES = [("DS투자증권", "%board.php%", "container"), ("신한증권", "%view.do%", "blocks")]
TEXT_ALIASES = {"DS": "DS투자증권", "신한": "신한증권"}
MODEL_CUTOFF = "20260101"
MOST_RETRIES = 3


def untagged(tags: Column) -> Column:
    return tags.isNull() | (F.size(tags) == 0)


def titled(title: Column) -> Column:
    return title.isNotNull() & (title != "")


def _untagged_titles(reports: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return reports.where(untagged(F.col("tags")) & titled(F.col("article_title"))).select(
        "report_id", "firm_nm", "article_title", *keep
    )


def not_yet_processed(reports: DataFrame, ledger: DataFrame, rule_version: str) -> DataFrame:
    """Leave out what this rule version has already seen.

    Rows whose result stays empty would otherwise be selected again for ever.
    """
    seen = ledger.where(F.col("rule_version") == rule_version).select("report_id")
    return reports.join(seen, "report_id", "left_anti")


def pending_reports(
    reports: DataFrame,
    n: int | None = None,
    ledger: DataFrame | None = None,
    rule_version: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """All untagged titled reports, or with ``n`` the newest ones by id; ``keep`` names further columns to carry along."""
    rows = _untagged_titles(reports, keep)
    if ledger is not None:
        rows = not_yet_processed(rows, ledger, rule_version)
    return rows if n is None else rows.orderBy(F.desc("report_id")).limit(n)


def backlog_reports(reports: DataFrame, batch_size: int = 5000, max_batches: int = 0) -> DataFrame:
    """The whole backlog, oldest first, with the number of its batch; with ``max_batches`` the first ones.

    The batch number only labels rows for progress figures: the backlog is
    enriched as one job. Without it ``pending_reports`` is the cheaper scan.
    Ids alone are numbered; titles meet their number in one join.
    """
    rows = _untagged_titles(reports)
    numbered = with_row_number(rows.select("report_id"), [F.col("report_id")])
    batches = numbered.select("report_id", (F.floor((F.col("rn") - 1) / batch_size) + 1).alias("batch_no"))
    if max_batches > 0:
        batches = batches.where(F.col("batch_no") <= max_batches)
    return rows.join(batches, "report_id")


def reports_by_keys(reports: DataFrame, keys: DataFrame) -> DataFrame:
    """Titled reports with one of the keys; a small key list is broadcast by its size."""
    hits = reports.where(titled(F.col("article_title"))).join(keys.select("key"), "key", "left_semi")
    return hits.select("report_id", "firm_nm", "article_title")


def report_by_id(reports: DataFrame, ids: DataFrame) -> DataFrame:
    """Each asked id with its report or the status ``report not found``."""
    found = reports.select("report_id", "firm_nm", "article_title", F.lit("found").alias("status"))
    return ids.select("report_id").join(found, "report_id", "left").fillna("report not found", ["status"])


def latest_sample(reports: DataFrame, n: int = 10) -> DataFrame:
    cols = ["report_id", "firm_nm", "article_title", "tags", "stock_names", "sector"]
    return reports.where(titled(F.col("article_title"))).select(*cols).orderBy(F.desc("report_id")).limit(n)


def text_candidates(
    pages: DataFrame,
    sources: DataFrame,
    n: int | None = None,
    saved: str = "save_time",
    ledger: DataFrame | None = None,
    rule_version: str | None = None,
) -> DataFrame:
    """All pages of source firms without body text, or with ``n`` the newest ones of each firm and their rank.

    The rank filter is pushed below the shuffle as a per-task limit, so a firm
    with a third of all pages sends at most ``n`` rows per task. A ledger keeps
    pages that never give a text from being taken again.
    """
    empty = is_blank(F.col("article_text"))
    hits = pages.where(empty).join(sources, "firm_nm").where("article_url LIKE url_like")
    if ledger is not None:
        hits = not_yet_processed(hits, ledger, rule_version)
    if n is None:
        return hits
    newest = W.partitionBy("firm_nm").orderBy(F.desc(saved), F.desc("report_id"))
    return hits.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= n)


def sources_for(sources: DataFrame, alias: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """The source of a firm alias; an unknown alias means all sources."""
    firm = (TEXT_ALIASES if aliases is None else aliases).get(alias)
    return sources if firm is None else sources.where(F.col("firm_nm") == firm)


def text_candidates_for(
    pages: DataFrame, sources: DataFrame, alias: str, n: int | None = None, aliases=None, saved: str = "save_time", **ledger
) -> DataFrame:
    return text_candidates(pages, sources_for(sources, alias, aliases), n, saved, **ledger)


def model_candidates(
    reports: DataFrame,
    cutoff: str = MODEL_CUTOFF,
    n: int | None = None,
    ledger: DataFrame | None = None,
    rule_version: str | None = None,
) -> DataFrame:
    """Recent untagged reports without sector that are linked or typed; with ``n`` linked ones first."""
    rows = reports.where(
        untagged(F.col("tags"))
        & titled(F.col("article_title"))
        & (F.col("reg_dt") >= cutoff)
        & (F.col("linked_summary_id").isNotNull() | F.col("report_type").isNotNull())
        & is_blank(F.col("sector"))
    ).select("report_id", "article_title", "linked_summary_id")
    if ledger is not None:
        rows = not_yet_processed(rows, ledger, rule_version)
    return rows if n is None else rows.orderBy(*model_order()).limit(n)


def model_order() -> list[Column]:
    return [F.desc_nulls_last("linked_summary_id"), F.desc("report_id")]


def summaries_missing_url(summaries: DataFrame, n: int | None = None) -> DataFrame:
    """Ids of all summaries without URL, or of the ``n`` lowest."""
    ids = summaries.where(is_blank(F.col("pdf_url"))).select("summary_id")
    return ids if n is None else ids.orderBy("summary_id").limit(n)


def retry_candidates(reports: DataFrame, most: int = MOST_RETRIES) -> DataFrame:
    """Failed rows: ``retry`` while tries are left, then ``dead``."""
    failed = reports.where(F.col("sync_status") == -1)
    return failed.withColumn("route", F.when(F.col("retry_count") < most, "retry").otherwise("dead"))

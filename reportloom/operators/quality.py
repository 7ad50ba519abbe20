"""Stored against recomputed values, coverage, and vocabulary the rules miss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numbering import with_running_sums
from ..functions.text import is_blank
from .candidates import untagged

# What counts as a word in each script.
SCRIPTS = {"korean": "[가-힣]{2,}", "english": "[A-Za-z]{3,}"}


def enrichment_diff(enriched: DataFrame, column: str = "enriched") -> DataFrame:
    """report_id, firm, title with ``existing``, ``simulated`` and ``matches`` structs."""
    new = F.col(column)
    cols = ["tags", "stock_names", "sector"]
    same = {"tags": "tags_match", "stock_names": "stocks_match", "sector": "sector_match"}
    return enriched.select(
        "report_id",
        "firm_nm",
        "article_title",
        F.struct(*cols).alias("existing"),
        F.struct(*[new[c].alias(c) for c in cols]).alias("simulated"),
        F.struct(*[F.col(c).eqNullSafe(new[c]).alias(same[c]) for c in cols]).alias("matches"),
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    rate = lambda c: F.round(F.avg(F.col(f"matches.{c}").cast("int")), 6)
    return diff.groupBy("firm_nm").agg(
        F.count("*").alias("n"),
        rate("tags_match").alias("tags_rate"),
        rate("stocks_match").alias("stocks_rate"),
        rate("sector_match").alias("sector_rate"),
    )


def coverage_summary(reports: DataFrame) -> DataFrame:
    """One row: total, tagged, three or more tags, untagged, and their ratios in percent."""
    tags = F.col("tags")
    counts = reports.agg(
        F.count("*").alias("total"),
        F.count_if(~untagged(tags)).alias("tagged"),
        F.count_if(F.coalesce(F.size(tags), F.lit(0)) >= 3).alias("three_or_more"),
        F.count_if(untagged(tags)).alias("untagged"),
    )
    return _with_ratios(counts)


def _with_ratios(counts: DataFrame) -> DataFrame:
    pct = lambda c: F.round(F.try_divide(F.col(c) * 100.0, F.col("total")), 4)
    return counts.withColumns({"tagged_pct": pct("tagged"), "untagged_pct": pct("untagged")})


# ---- counts by month: only touched months are counted again -----------------------


def month_coverage(reports: DataFrame, month: str = "reg_month") -> DataFrame:
    """One row of mergeable counts per month."""
    tags = F.col("tags")
    return reports.groupBy(month).agg(
        F.count("*").alias("total"),
        F.count_if(~untagged(tags)).alias("tagged"),
        F.count_if(F.coalesce(F.size(tags), F.lit(0)) >= 3).alias("three_or_more"),
        F.count_if(untagged(tags)).alias("untagged"),
    )


def month_tags(reports: DataFrame, month: str = "reg_month") -> DataFrame:
    """(month, tag, n), exact counts."""
    return reports.select(month, F.explode_outer("tags").alias("tag")).where("tag is not null").groupBy(month, "tag").agg(F.count("*").alias("n"))


def coverage_of_months(counts: DataFrame) -> DataFrame:
    """``coverage_summary`` from the counts of all months."""
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "tagged", "three_or_more", "untagged")])
    return _with_ratios(sums)


def tag_topk_of_months(before: DataFrame, after: DataFrame, k: int = 20) -> DataFrame:
    """``tag_topk_delta`` from the tag counts of all months, as they were and as they are."""
    total = lambda df, out: df.groupBy("tag").agg(F.sum("n").alias(out))
    return _most_changed(total(before, "n_before"), total(after, "n_after"), k)


def tag_topk_delta(before: DataFrame, after: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent tags with their counts before and after."""
    # outer, for otherwise a filter on the tags is derived and they are computed twice
    tags = lambda df: df.select(F.explode_outer("tags").alias("tag")).where("tag is not null")
    count = lambda df, out: tags(df).groupBy("tag").agg(F.count("*").alias(out))
    return _most_changed(count(before, "n_before"), count(after, "n_after"), k)


def _most_changed(before: DataFrame, after: DataFrame, k: int) -> DataFrame:
    both = before.join(after, "tag", "full").fillna(0, ["n_before", "n_after"])
    return (
        both.withColumn("change", F.col("n_after") - F.col("n_before"))
        .orderBy(F.desc("n_after"), F.desc("n_before"), "tag")
        .limit(k)
    )


def token_counts(df: DataFrame, text: str) -> DataFrame:
    """(script, token, n) over whole texts; both scripts in one scan and one shuffle."""

    def words(script: str) -> Column:
        found = F.regexp_extract_all(F.col(text), F.lit(SCRIPTS[script]), F.lit(0))
        return F.transform(found, lambda w: F.struct(F.lit(script).alias("script"), w.alias("token")))

    both = F.concat(*[words(s) for s in SCRIPTS])
    return df.select(F.explode(both).alias("w")).groupBy("w.script", "w.token").agg(F.count("*").alias("n"))


def unclassified(reports: DataFrame) -> DataFrame:
    """Reports with neither tags nor sector."""
    return reports.where(untagged(F.col("tags")) & is_blank(F.col("sector")))


def unclassified_tokens(reports: DataFrame, text: str = "article_title", k: int = 100) -> DataFrame:
    """The k most frequent words per script among unclassified titles.

    The rank filter is applied per task before the shuffle, so of a vocabulary
    of any size each task passes on k words per script.
    """
    frequent = W.partitionBy("script").orderBy(F.desc("n"), "token")
    ranked = token_counts(reports, text).withColumn("rn", F.row_number().over(frequent))
    return ranked.where(F.col("rn") <= k).drop("rn")


def missing_keywords(tokens: DataFrame, sector_words: DataFrame) -> DataFrame:
    """Frequent words the sector table does not have yet."""
    return tokens.join(sector_words.select(F.col("word").alias("token")), "token", "left_anti")


def throughput_log(batches: DataFrame) -> DataFrame:
    """Rows per second of each batch and up to it; ``batches`` has batch, n_rows, micros."""
    run = with_running_sums(batches, [F.col("batch")], {"rows_upto": "n_rows", "micros_upto": "micros"})

    def rate(rows: str, micros: str) -> Column:
        return F.round(F.try_divide(F.col(rows).cast("double") * 1_000_000, F.col(micros)), 4)

    return run.select(
        "batch",
        "n_rows",
        F.round(F.col("micros") / 1_000_000, 6).alias("seconds"),
        rate("n_rows", "micros").alias("rate"),
        "rows_upto",
        rate("rows_upto", "micros_upto").alias("rate_upto"),
    )

"""Body text out of stored HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Container patterns in order, block pattern, and length gates.
CONTAINER_PATTERNS = (
    r'id="bo_v_con">(.*?)</div>\s*(?:</section|<script|<div class="bo_v_)',
    r'id="bo_v_con">(.*?)(?:</section)',
    r'id="bo_v_con">(.*?)</div>',
)
BLOCK_PATTERN = r"<div[^>]*>(.*?)</div>"
CONTAINER_LEAST, BLOCK_LEAST, MOST = 30, 200, 10_000


def clean_markup(html: Column) -> Column:
    """Tags and hard spaces become blanks, runs of white space one blank."""
    bare = F.replace(F.regexp_replace(html, r"<[^>]+>", " "), F.lit("&nbsp;"), F.lit(" "))
    return F.trim(F.regexp_replace(bare, r"(?U)[\s\x1c-\x1f]+", " "))


def text_gates(text: Column, least: int = CONTAINER_LEAST, most: int | None = None) -> Column:
    """Null unless longer than ``least``; whole, or with ``most`` (``MOST`` in the established jobs) cut to so many characters."""
    return F.when(F.length(text) > least, text if most is None else F.left(text, F.lit(most)))


def container_html(html: Column, patterns=CONTAINER_PATTERNS) -> Column:
    """Inner HTML by the first pattern that matches; null where none does."""
    # one scan a pattern; an absent match has no first element, an empty one has
    found = [F.get(F.regexp_extract_all(html, F.lit(f"(?s){p}"), F.lit(1)), F.lit(0)) for p in patterns]
    return F.coalesce(*found)


def container_text(html: Column, patterns=CONTAINER_PATTERNS, most: int | None = None) -> Column:
    return text_gates(clean_markup(container_html(html, patterns)), CONTAINER_LEAST, most)


def first_long_block(html: Column, pattern: str = BLOCK_PATTERN, most: int | None = None) -> Column:
    """The first block whose clean text is longer than the block gate."""
    # a block that is short as it stands is short when cleaned
    raw = F.filter(F.regexp_extract_all(html, F.lit(f"(?s){pattern}"), F.lit(1)), lambda b: F.length(b) > BLOCK_LEAST)
    first = F.get(F.filter(F.transform(raw, clean_markup), lambda b: F.length(b) > BLOCK_LEAST), F.lit(0))
    return text_gates(first, BLOCK_LEAST, most)


def extract_by_source(
    pages: DataFrame, sources: DataFrame, patterns=CONTAINER_PATTERNS, block: str = BLOCK_PATTERN, most: int | None = None
) -> DataFrame:
    """(report_id, firm_nm, article_text) by the rule of the page's firm."""
    html = F.col("html")
    text = F.when(F.col("rule") == "container", container_text(html, patterns, most)).when(
        F.col("rule") == "blocks", first_long_block(html, block, most)
    )
    ruled = pages if "rule" in pages.columns else pages.join(sources.select("firm_nm", "rule"), "firm_nm")
    return ruled.select("report_id", "firm_nm", text.alias("article_text"))


def utf8_quarantine(pages: DataFrame, raw: str = "html_bytes", out: str = "html") -> DataFrame:
    """Decode; rows that are not UTF-8 keep their bytes, a null text and ``quarantined``."""
    text = F.try_validate_utf8(F.col(raw).cast("string"))
    return pages.withColumn(out, text).withColumn("quarantined", F.col(out).isNull() & F.col(raw).isNotNull())


def text_yield(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """Per firm: how many candidates there were and how many got a text."""
    got = texts.where("article_text is not null").select("report_id", F.lit(1).alias("got"))
    return (
        candidates.join(got, "report_id", "left")
        .groupBy("firm_nm")
        .agg(F.count("got").alias("updated"), F.count("*").alias("total"))
    )

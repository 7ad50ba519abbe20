"""Prompts for, and recorded JSON answers of, an external tagging model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import with_row_number
from ..functions.text import empty_strings, strip
from .candidates import model_order

# Titles per prompt and the prompt.
TITLES_PER_PROMPT = 10
PROMPT_HEAD = (
    'Return ONE JSON array for ALL titles below. Each: {"id":N,"tags":[],"sector":"...","stock_names":[],'
    '"report_type":"COMPANY|INDUSTRY|MACRO|STRATEGY|QUANT"}. Output ONLY the array, no markdown.\n\nTitles:\n'
)


def prompt_batches(candidates: DataFrame, size: int = TITLES_PER_PROMPT) -> DataFrame:
    """(batch, ids, prompt): ``size`` titles each, in candidate order."""
    numbered = with_row_number(candidates, model_order())
    line = F.concat(F.col("report_id").cast("string"), F.lit(": "), F.col("article_title"))
    batched = numbered.select(
        F.floor((F.col("rn") - 1) / size).alias("batch"), F.struct("rn", "report_id", line.alias("line")).alias("item")
    )
    # at most ``size`` rows per group
    items = batched.groupBy("batch").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return items.select(
        "batch",
        F.col("items.report_id").alias("ids"),
        F.concat(F.lit(PROMPT_HEAD), F.array_join(F.col("items.line"), "\n")).alias("prompt"),
    )


def repair_json_text(text: Column) -> Column:
    """Strip code fences and join arrays that were sent one after another."""
    bare = F.regexp_replace(strip(text), r"(?m)^```(?:json)?\s*\n?", "")
    bare = F.regexp_replace(bare, r"(?m)\n?```\s*$", "")
    joined = F.replace(bare, F.lit("]\n["), F.lit(",\n"))
    return strip(F.replace(joined, F.lit("]["), F.lit(",")))


def parse_answers(answers: DataFrame, text: str = "answer", order: str = "answer_no") -> DataFrame:
    """One row per answered title: a list, or the ``results`` of an object.

    Text that is no JSON gives no rows.
    """
    parsed = F.try_parse_json(repair_json_text(F.col(text)))
    items = F.coalesce(
        F.try_variant_get(parsed, "$", "array<variant>"), F.try_variant_get(parsed, "$.results", "array<variant>")
    )
    rows = answers.select(order, F.posexplode(items).alias("pos", "item"))
    item = F.col("item")
    return rows.select(
        order,
        "pos",
        F.try_variant_get(item, "$.id", "bigint").alias("id"),
        F.try_variant_get(item, "$.tags", "variant").alias("tags"),
        F.try_variant_get(item, "$.sector", "string").alias("sector"),
        F.try_variant_get(item, "$.stock_names", "variant").alias("stock_names"),
        F.try_variant_get(item, "$.report_type", "string").alias("report_type"),
    )


def coerce_tags(value: Column) -> Column:
    """A list stays; any other value becomes a list of one; no value, "", 0, false and {} give an empty list.

    The kind of the value decides: the text "0" is a tag, the number 0 is none.
    """
    kind = F.schema_of_variant(value)
    as_text = F.try_variant_get(value, "$", "string")
    as_json = F.to_json(value)
    one = (
        F.when(value.isNull() | (kind == "VOID"), None)
        .when(kind == "STRING", F.nullif(as_text, F.lit("")))
        .when(kind == "BOOLEAN", F.when(F.try_variant_get(value, "$", "boolean"), "True"))
        .when(F.startswith(kind, F.lit("OBJECT")), F.nullif(as_json, F.lit("{}")))
        .when(F.try_variant_get(value, "$", "double") != 0, as_text)
    )
    as_list = F.try_variant_get(value, "$", "array<string>")
    return F.when(F.startswith(kind, F.lit("ARRAY")), as_list).when(one.isNotNull(), F.array(one)).otherwise(empty_strings())


def latest_answer_per_id(parsed: DataFrame, order: str = "answer_no") -> DataFrame:
    """Of repeated ids the last answer wins; rows without an id are dropped.

    Map-side combine keeps one candidate per id and task, whatever the copies.
    """
    tidy = parsed.where(F.coalesce(F.col("id"), F.lit(0)) != 0).select(
        F.col("id").alias("report_id"),
        F.struct(
            order,
            "pos",
            coerce_tags(F.col("tags")).alias("tags"),
            F.coalesce("sector", F.lit("")).alias("sector"),
            coerce_tags(F.col("stock_names")).alias("stock_names"),
            F.coalesce("report_type", F.lit("")).alias("report_type"),
        ).alias("answer"),
    )
    last = tidy.groupBy("report_id").agg(F.max("answer").alias("answer"))
    return last.select("report_id", *[f"answer.{c}" for c in ("tags", "sector", "stock_names", "report_type")])


def answer_coverage(prompts: DataFrame, latest: DataFrame) -> DataFrame:
    """Per prompt batch: titles asked, titles answered, percent."""
    asked = prompts.select("batch", F.explode("ids").alias("report_id"))
    got = latest.select("report_id", F.lit(1).alias("got"))
    counts = asked.join(got, "report_id", "left").groupBy("batch").agg(
        F.count("got").alias("enriched"), F.count("*").alias("total")
    )
    return counts.withColumn("pct", F.round(F.col("enriched") * 100 / F.col("total"), 1))

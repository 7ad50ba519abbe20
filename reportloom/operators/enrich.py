"""The whole title enrichment as one chain of projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import dictionaries as D
from ..functions.text import strip
from . import entities as E
from . import sectors as S
from . import structured as P
from . import tags as T

MODEL = "rule-based"
TAG_COLUMNS = ["tags", "stock_names", "sector"]
PREMIUM_COLUMNS = ["target_price", "rating", "revision_type", "report_type", "stock_tickers"]


def enrich_titles(
    df: DataFrame,
    lex: D.Dictionary,
    sector_words: D.Dictionary,
    tag_pack=None,
    action_pack=None,
    title: str = "article_title",
    key: str = "report_id",
    out: str = "enriched",
    compat: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Add ``out``, the enrichment of every title.

    ``tags`` and ``stock_names`` have the published length; ``all_tags`` and
    ``all_names`` are the same lists uncut.

    With dictionaries that fit inline this is projections only: no shuffle, no
    join, no Python. A blank title gives the empty result with a note; a null
    title gives status ``error``. ``compat`` keeps known oddities of the
    established rules (word edges after punctuation, short Latin sector words,
    unseparated prices, tickers of the first five names only). ``tasks``: the
    number of tasks that ``df`` is dealt out to by ``key``, if it is.
    """
    t = F.col("_t")
    work = df.withColumn("_t", F.coalesce(strip(F.col(title)), F.lit("")))
    work = E.with_candidates(work, "_t", lex, "_lex", key, {"_words": sector_words}, tasks)
    tag_pack = rules.tag_rules() if tag_pack is None else tag_pack
    action_pack = rules.action_rules() if action_pack is None else action_pack
    work = T.with_rule_text(work, "_t", tag_pack, action_pack)
    work = work.withColumns({"_all": E.entity_names(t, F.col("_lex"), compat)})
    work = work.withColumns(
        {
            "_sector": S.sector(
                E.sector_of_names(F.col("_all"), F.col("_lex"), F.col("_words")),
                S.keyword_sector(t, F.col("_words"), compat),
            ),
            "_rules": T.matching_rules("_t", tag_pack, action_pack),
            "_names": T.clip(F.col("_all"), E.MAX_NAMES),
            "_price": P.price_target(t, compat),
        }
    )
    labels, action = T.labels_and_action(F.col("_rules"), tag_pack, action_pack)
    work = work.withColumns({"_labels": labels, "_action": action})
    tags = T.merge_action(F.col("_labels"), F.col("_action"))
    tags = T.suppress_sector_overlap(tags, F.col("_sector"))
    tags = T.suppress_entity_overlap(tags, F.col("_all"))
    tags = T.default_company_tag(tags, F.col("_all"))
    named = F.col("_names") if compat else F.col("_all")
    work = work.withColumns({"_tags": tags, "_tickers": P.tickers(t, named, F.col("_lex"))})

    given = F.col(title).isNotNull()
    titled = t != ""
    enriched = F.struct(
        T.clip(F.col("_tags"), T.MAX_TAGS).alias("tags"),
        F.col("_names").alias("stock_names"),
        F.col("_sector").alias("sector"),
        F.col("_action").alias("action_type"),
        F.when(given, "success").otherwise("error").alias("status"),
        F.lit(MODEL).alias("model"),
        F.when(~given, "null title").when(~titled, "no title").alias("note"),
        F.when(titled, P.price_value(F.col("_price.raw"))).alias("target_price"),
        P.revision_type(F.col("_price.action")).alias("revision_type"),
        P.rating(t).alias("rating"),
        P.report_type(t, F.col("_tickers")).alias("report_type"),
        F.col("_tickers").alias("stock_tickers"),
        F.col("_tags").alias("all_tags"),
        F.col("_all").alias("all_names"),
    )
    return work.withColumn(out, enriched).drop(
        "_t", "_lex", "_words", "_folded", "_pairs", "_all", "_sector", "_rules", "_labels", "_action", "_names", "_price", "_tags", "_tickers"
    )


def flatten(df: DataFrame, key: str = "report_id", column: str = "enriched") -> DataFrame:
    """The enrichment as an update set: key and the eight stored columns."""
    return df.select(key, *[f"{column}.{c}" for c in TAG_COLUMNS + PREMIUM_COLUMNS])

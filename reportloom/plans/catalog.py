"""Named queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.spread import spread
from ..operators import enrich as N
from ..operators import entities as E
from ..operators import sectors as S
from ..sources import adapters as A


#: Titles of one task of enrichment, so that its time and memory do not grow with the table.
TASK_ROWS = 50_000


class Tables:
    """The views of one scale factor, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, inline_rows: int = D.INLINE_ROWS, named: dict[str, str] | None = None):
        self.spark, self.sf_dir, self.inline_rows, self.named = spark, sf_dir, inline_rows, named or {}

    def joined(self) -> Tables:
        """The same views with dictionaries that are joined, as those beyond ``INLINE_ROWS`` are."""
        return Tables(self.spark, self.sf_dir, 0)

    def companies(self) -> Tables:
        """Titles of customers and suppliers, and dictionaries of all of them, which grow with the tables; joined at any size."""
        return Tables(self.spark, self.sf_dir, 0, COMPANIES)

    @property
    def cores(self) -> int:
        return self.spark.sparkContext.defaultParallelism

    @cached_property
    def tasks(self) -> int:
        """Tasks for title work: as many rounds of all cores as keep a task at ``TASK_ROWS`` titles. Reads file footers."""
        return self.cores * max(1, -(-self.base("orders").count() // (TASK_ROWS * self.cores)))

    def view(self, name: str) -> DataFrame:
        return A.view(self.spark, self.sf_dir, self.named.get(name, name))

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def reports(self) -> DataFrame:
        return self.view("reports")

    @cached_property
    def summaries(self) -> DataFrame:
        return self.view("summaries")

    @cached_property
    def lexicon(self) -> D.Dictionary:
        searched = F.when(F.col("grp") < 2, F.col("pos"))
        table = self.view("lexicon").select(
            searched.alias("rank"), "word", "code", "sector", F.col("pos").alias("ticker_rank")
        )
        return E.lexicon(table, self.inline_rows, self.view("sector_words"))

    @cached_property
    def sector_words(self) -> D.Dictionary:
        return S.sector_dictionary(self.view("sector_words"), self.inline_rows)

    @cached_property
    def titles(self) -> DataFrame:
        return spread(self.reports.select("report_id", "firm_nm", "article_title"), "report_id", self.tasks)

    def enriched(self, df: DataFrame | None = None, **options) -> DataFrame:
        if df is None:
            df, options = self.titles, {"tasks": self.tasks} | options
        return N.enrich_titles(df, self.lexicon, self.sector_words, **options)


#: The views of titles and dictionaries, and those that take their place for a company table of real size.
COMPANIES = {"reports": "company_reports", "lexicon": "company_lexicon", "sector_words": "company_words"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)``; ``sql`` continues the WITH list of the views."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def oracle(text: str) -> str:
    """Prefix the views a SQL text uses; it may start with more named tables (', x as (...)')."""
    used = [n for n in A.VIEWS if re.search(rf"\b{n}\b", text)]
    views = ", ".join(f"{n} as ({A.duckdb_sql(n)})" for n in used)
    text = text.strip()
    if not views:
        return "with " + text[1:].strip() if text.startswith(",") else text
    return f"with {views} {text}"


def of_companies(text: str) -> str:
    """The same SQL over the company views."""
    return re.sub(rf"\b({'|'.join(COMPANIES)})\b", lambda m: COMPANIES[m[1]], text)

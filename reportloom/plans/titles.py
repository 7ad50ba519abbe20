"""Queries of the title steps: candidates, entities, sectors, tags, structured fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions.lists import bar
from ..functions.text import strip
from ..operators import candidates as C
from ..operators import entities as E
from ..operators import sectors as S
from ..operators import structured as P
from ..operators import tags as T
from . import steps as Q
from .catalog import Tables, of_companies, query

UNTAGGED = "(tags is null or len(tags) = 0) and article_title is not null and article_title <> ''"


def every_title(select: str, column: str, none: str = "''") -> str:
    """SQL: the column for all titles, also those the inner query has no row for."""
    return f" select t.report_id, coalesce(x.{column}, {none}) as {column} from titles t left join ({select}) x using (report_id)"


def stripped(t: Tables) -> DataFrame:
    return t.titles.withColumn("title", F.coalesce(strip(F.col("article_title")), F.lit("")))


def with_lexicon(t: Tables) -> DataFrame:
    return E.with_candidates(stripped(t), "title", t.lexicon, "lex", "report_id", tasks=t.tasks)


def with_words(t: Tables, df: DataFrame) -> DataFrame:
    return D.with_contained(df, "report_id", "title", t.sector_words, "words", t.tasks)


def with_names(t: Tables) -> DataFrame:
    return with_lexicon(t).withColumn("names", E.entity_names(F.col("title"), F.col("lex")))


def with_sector(t: Tables, compat: bool = False) -> DataFrame:
    df = with_words(t, with_names(t))
    by_name = E.sector_of_names(F.col("names"), F.col("lex"), F.col("words"))
    return df.withColumn("sector", S.sector(by_name, S.keyword_sector(F.col("title"), F.col("words"), compat)))


def with_tags(t: Tables) -> DataFrame:
    df = T.with_rule_text(with_sector(t), "title").withColumns(
        {
            "labels": T.matching_labels("title"),
            "action": T.first_label("title"),
        }
    )
    return df.withColumn("merged", T.merge_action(F.col("labels"), F.col("action")))


# ---- candidates ------------------------------------------------------------------

@query("pending_reports", f"select report_id, firm_nm, article_title from reports where {UNTAGGED}")
def _(t: Tables):
    return C.pending_reports(t.reports)


def _seen(t: Tables) -> DataFrame:
    """A ledger of rule version v2 with every third report, and of v1 with all."""
    ids = t.reports.select("report_id")
    return ids.where("report_id % 3 = 0").withColumn("rule_version", F.lit("v2")).unionByName(ids.withColumn("rule_version", F.lit("v1")))


@query("pending_reports_with_ledger", f"select report_id, firm_nm, article_title from reports where {UNTAGGED} and report_id % 3 <> 0")
def _(t: Tables):
    return C.pending_reports(t.reports, ledger=_seen(t), rule_version="v2")


@query(
    "pending_reports_newest",
    f"select report_id, firm_nm, article_title from reports where {UNTAGGED} and report_id % 3 <> 0 order by report_id desc limit 100",
)
def _(t: Tables):
    return C.pending_reports(t.reports, 100, _seen(t), "v2")


@query("model_candidates_with_ledger", f"select report_id, article_title, linked_summary_id from reports where {UNTAGGED} and reg_dt >= '19970101'"
    " and (linked_summary_id is not null or report_type is not null) and (sector is null or sector = '') and report_id % 3 <> 0")
def _(t: Tables):
    return C.model_candidates(t.reports, cutoff="19970101", ledger=_seen(t), rule_version="v2")


@query(
    "text_candidates_newest",
    ", sources as (select * from (values ('FIRM00', '%page=%', 'container'), ('FIRM01', 'http://%', 'blocks')) s(firm_nm, url_like, rule))"
    " select report_id, firm_nm, save_rank, rn from (select p.report_id, p.firm_nm, p.save_rank,"
    " row_number() over (partition by p.firm_nm order by p.save_rank desc, p.report_id desc) as rn"
    " from report_pages p join sources s on s.firm_nm = p.firm_nm and p.article_url like s.url_like"
    " where (p.article_text is null or p.article_text = '') and p.report_id % 3 <> 0) where rn <= 20",
)
def _(t: Tables):
    pages = t.view("report_pages")
    seen = pages.where("report_id % 3 = 0").select("report_id", F.lit("v2").alias("rule_version"))
    found = C.text_candidates(pages, sources(t), 20, "save_rank", seen, "v2")
    return found.select("report_id", "firm_nm", "save_rank", F.col("rn").cast("bigint").alias("rn"))


@query(
    "backlog_reports",
    f"select report_id, firm_nm, article_title, (row_number() over (order by report_id) - 1) // 5000 + 1 as batch_no from reports where {UNTAGGED}",
)
def _(t: Tables):
    return C.backlog_reports(t.reports)


@query(
    "reports_by_keys",
    "select report_id, firm_nm, article_title from reports where article_title is not null and article_title <> ''"
    " and key in (select 'K' || cast(event_id as varchar) from events where event_type = 'purchase')",
)
def _(t: Tables):
    keys = t.base("events").where("event_type = 'purchase'").select(F.concat(F.lit("K"), F.col("event_id").cast("string")).alias("key"))
    return C.reports_by_keys(t.reports, keys)


@query(
    "report_by_id",
    "select i.report_id, r.firm_nm, r.article_title, case when r.report_id is null then 'report not found' else 'found' end as status"
    " from (select p_partkey * 9 as report_id from part) i left join reports r on r.report_id = i.report_id",
)
def _(t: Tables):
    return C.report_by_id(t.reports, t.base("part").select((F.col("p_partkey") * 9).alias("report_id")))


@query(
    "latest_sample",
    "select report_id, firm_nm, article_title, coalesce(array_to_string(tags, '|'), '-') as tags,"
    " coalesce(array_to_string(stock_names, '|'), '-') as stock_names, sector"
    " from reports where article_title is not null and article_title <> '' order by report_id desc limit 10",
)
def _(t: Tables):
    shown = {c: F.coalesce(bar(F.col(c)), F.lit("-")) for c in ("tags", "stock_names")}
    return C.latest_sample(t.reports).withColumns(shown)


_SOURCES = [("FIRM00", "%page=%", "container"), ("FIRM01", "http://%", "blocks")]
_SOURCES_SQL = ", sources as (select * from (values ('FIRM00', '%page=%', 'container'), ('FIRM01', 'http://%', 'blocks')) s(firm_nm, url_like, rule))"
_TEXT_SQL = """
select report_id, firm_nm, article_url, save_rank, rule from (
 select p.report_id, p.firm_nm, p.article_url, p.save_rank, s.rule,
  row_number() over (partition by p.firm_nm order by p.save_rank desc, p.report_id desc) as rn
 from report_pages p join sources s on s.firm_nm = p.firm_nm and p.article_url like s.url_like
 where p.article_text is null or p.article_text = ''
) where true
"""


def sources(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(_SOURCES, "firm_nm string, url_like string, rule string")


def _text_columns(df: DataFrame) -> DataFrame:
    return df.select("report_id", "firm_nm", "article_url", "save_rank", "rule")


@query("text_candidates", _SOURCES_SQL + _TEXT_SQL)
def _(t: Tables):
    return _text_columns(C.text_candidates(t.view("report_pages"), sources(t), saved="save_rank"))


@query("text_candidates_for", _SOURCES_SQL + _TEXT_SQL + " and firm_nm = 'FIRM01'")
def _(t: Tables):
    found = C.text_candidates_for(t.view("report_pages"), sources(t), "one", aliases={"one": "FIRM01"}, saved="save_rank")
    return _text_columns(found)


_MODEL_WHERE = f"{UNTAGGED} and reg_dt >= '19970101' and (linked_summary_id is not null or report_type is not null) and (sector is null or sector = '')"


@query(
    "model_candidates",
    f"select report_id, article_title, linked_summary_id from reports where {_MODEL_WHERE}",
)
def _(t: Tables):
    return C.model_candidates(t.reports, cutoff="19970101")


@query(
    "summaries_missing_url",
    "select summary_id from summaries where pdf_url is null or pdf_url = ''",
)
def _(t: Tables):
    return C.summaries_missing_url(t.summaries)


@query(
    "retry_candidates",
    "select event_id as report_id, user_id % 5 as retry_count, case when user_id % 5 < 3 then 'retry' else 'dead' end as route"
    " from events where event_type = 'error'",
)
def _(t: Tables):
    status = t.base("events").select(
        F.col("event_id").alias("report_id"),
        F.when(F.col("event_type") == "error", -1).otherwise(2).alias("sync_status"),
        (F.col("user_id") % 5).alias("retry_count"),
    )
    return C.retry_candidates(status).drop("sync_status")


# ---- entities --------------------------------------------------------------------

@query("entities_with_code", Q.STOP + Q.TITLES + Q.CODED + "select report_id, pos, name, code from coded")
def _(t: Tables):
    mentions = stripped(t).select("report_id", F.posexplode(E.coded_mentions(F.col("title"))).alias("pos", "m"))
    return mentions.select("report_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "m.name", "m.code")


@query("code_alias_lookup", Q.STOP + Q.TITLES + Q.CODED + Q.ALIAS + every_title(
    "select c.report_id, c.name || case when a.name is null then '' else '|' || a.name end as names"
    " from coded c left join alias a on a.report_id = c.report_id and a.pos = c.pos", "names"))
def _(t: Tables):
    names = E.names_with_aliases(E.coded_mentions(F.col("title")), F.col("lex"))
    return with_lexicon(t).select("report_id", bar(names).alias("names"))


@query("entities_bracket_opinion", Q.TITLES + Q.BRACKET + "select report_id, name from bracketed")
def _(t: Tables):
    return stripped(t).select("report_id", F.explode(E.bracket_names(F.col("title"))).alias("name"))


@query("entities_known", Q.TITLES + Q.KNOWN + every_title(
    "select report_id, string_agg(name, '|' order by pos) as names from known group by report_id", "names"))
def _(t: Tables):
    return with_lexicon(t).select("report_id", bar(E.known_names(F.col("title"), F.col("lex"))).alias("names"))


_WORDS_SQL = """
, words as (select report_id, unnest(string_split(title, ' ')) as word, generate_subscripts(string_split(title, ' '), 1) as pos from titles)
"""


@query("drop_stop_names", Q.STOP + Q.TITLES + _WORDS_SQL + every_title(
    "select report_id, string_agg(word, '|' order by pos) as kept from words where word not in (select word from stop) group by report_id", "kept"))
def _(t: Tables):
    kept = E.drop_stop_names(F.split("title", " "))
    return stripped(t).select("report_id", bar(kept).alias("kept"))


@query("entities_distinct", Q.TITLES + _WORDS_SQL + """
select report_id, string_agg(word, '|' order by pos) as names from (select report_id, word, min(pos) as pos from words group by report_id, word) group by report_id""")
def _(t: Tables):
    return stripped(t).select("report_id", bar(E.distinct_in_order(F.split("title", " "))).alias("names"))


@query("entity_mentions", Q.ENTITY_STEPS + every_title(
    "select report_id, string_agg(name, '|' order by i) as stock_names from names group by report_id", "stock_names"))
def _(t: Tables):
    found = E.entity_mentions(t.titles.fillna("", ["article_title"]), t.lexicon)
    return found.select("report_id", bar(F.col("stock_names")).alias("stock_names"))


@query("entity_mentions_joined", Q.ENTITY_STEPS + every_title(
    "select report_id, string_agg(name, '|' order by i) as stock_names from names group by report_id", "stock_names"))
def _(t: Tables):
    found = E.entity_mentions(t.titles.fillna("", ["article_title"]), t.joined().lexicon)
    return found.select("report_id", bar(F.col("stock_names")).alias("stock_names"))


# ---- sectors ---------------------------------------------------------------------

@query("sector_by_entity", Q.ENTITY_STEPS + Q.NAME_SECTOR + every_title("select report_id, sector from name_sector", "sector", "null"))
def _(t: Tables):
    df = with_words(t, with_names(t))
    by_name = E.sector_of_names(F.col("names"), F.col("lex"), F.col("words"))
    return df.select("report_id", by_name.alias("sector"))


def _by_word(t: Tables, compat: bool) -> DataFrame:
    df = with_words(t, stripped(t))
    return df.select("report_id", S.keyword_sector(F.col("title"), F.col("words"), compat).alias("sector"))


@query("sector_by_keyword", Q.TITLES + Q.word_sector() + every_title("select report_id, sector from word_sector", "sector", "null"))
def _(t: Tables):
    return _by_word(t, False)


@query("sector_by_keyword_compat", Q.TITLES + Q.word_sector(True) + every_title("select report_id, sector from word_sector", "sector", "null"))
def _(t: Tables):
    return _by_word(t, True)


@query("sector", Q.SECTOR_STEPS + "select report_id, sector from sectors")
def _(t: Tables):
    return with_sector(t).select("report_id", "sector")


# ---- tags ------------------------------------------------------------------------

@query("tag_matches", Q.TITLES + Q.LABELS + every_title(
    "select report_id, string_agg(label, '|' order by ord) as labels from labels group by report_id", "labels"))
def _(t: Tables):
    df = T.with_rule_text(stripped(t), "title")
    return df.select("report_id", bar(T.matching_labels("title")).alias("labels"))


@query("action_type", Q.TITLES + Q.ACTIONS + "select report_id, action from actions")
def _(t: Tables):
    df = T.with_rule_text(stripped(t), "title")
    return df.select("report_id", T.first_label("title").alias("action"))


@query("merge_action", Q.TITLES + Q.LABELS + Q.ACTIONS + Q.MERGED + every_title(
    "select report_id, string_agg(label, '|' order by ord) as tags from merged group by report_id", "tags"))
def _(t: Tables):
    df = T.with_rule_text(stripped(t), "title")
    df = df.select(
        "report_id",
        T.matching_labels("title").alias("labels"),
        T.first_label("title").alias("action"),
    )
    return df.select("report_id", bar(T.merge_action(F.col("labels"), F.col("action"))).alias("tags"))


@query("suppress_sector_overlap", Q.SECTOR_STEPS + Q.LABELS + Q.ACTIONS + Q.MERGED + Q.NO_SECTOR + every_title(
    "select report_id, string_agg(label, '|' order by ord) as tags from no_sector group by report_id", "tags"))
def _(t: Tables):
    tags = T.suppress_sector_overlap(F.col("merged"), F.col("sector"))
    return with_tags(t).select("report_id", bar(tags).alias("tags"))


# title words as tags, so that many overlap with the names
@query("suppress_entity_overlap", Q.ENTITY_STEPS + _WORDS_SQL + every_title("""
select w.report_id, string_agg(w.word, '|' order by w.pos) as tags from words w where not exists (
 select 1 from names n where n.report_id = w.report_id and (n.name = w.word
  or (length(w.word) >= 2 and (contains(n.name, w.word) or contains(w.word, n.name)))))
group by w.report_id""", "tags"))
def _(t: Tables):
    tags = T.suppress_entity_overlap(F.split("title", " "), F.col("names"))
    return with_names(t).select("report_id", bar(tags).alias("tags"))


@query("default_company_tag", Q.TAG_STEPS + every_title(
    "select report_id, string_agg(label, '|' order by i) as tags from tagged group by report_id", "tags"))
def _(t: Tables):
    return _clean_tags(t).select("report_id", bar(F.col("tags")).alias("tags"))


def _clean_tags(t: Tables) -> DataFrame:
    tags = T.suppress_sector_overlap(F.col("merged"), F.col("sector"))
    tags = T.suppress_entity_overlap(tags, F.col("names"))
    return with_tags(t).withColumn("tags", T.default_company_tag(tags, F.col("names")))


@query("clip_lists", Q.TAG_STEPS + """
select t.report_id,
 coalesce((select string_agg(label, '|' order by i) from tagged g where g.report_id = t.report_id and g.i <= 8), '') as tags,
 coalesce((select string_agg(name, '|' order by i) from names n where n.report_id = t.report_id and n.i <= 5), '') as names
from titles t""")
def _(t: Tables):
    return _clean_tags(t).select(
        "report_id", bar(T.clip(F.col("tags"), T.MAX_TAGS)).alias("tags"), bar(T.clip(F.col("names"), E.MAX_NAMES)).alias("names")
    )


@query("full_lists", Q.TAG_STEPS + """
select t.report_id,
 coalesce((select string_agg(label, '|' order by i) from tagged g where g.report_id = t.report_id), '') as tags,
 coalesce((select string_agg(name, '|' order by i) from names n where n.report_id = t.report_id), '') as names
from titles t""")
def _(t: Tables):
    e = F.col("enriched")
    return t.enriched().select("report_id", bar(e["all_tags"]).alias("tags"), bar(e["all_names"]).alias("names"))


ENRICHED_COLUMNS = (
    "report_id, tags, stock_names, sector, action_type, status, model, note, target_price, revision_type, rating, report_type, stock_tickers"
)


def flat_enriched(df: DataFrame) -> DataFrame:
    """Lists as strings, so that both engines compare equal."""
    cols = [c for c in ENRICHED_COLUMNS.split(", ") if c != "report_id"]
    lists = {"tags", "stock_names", "stock_tickers"}
    e = F.col("enriched")
    return df.select("report_id", *[(bar(e[c]) if c in lists else e[c]).alias(c) for c in cols])


@query("enrich_titles", Q.ENRICH_STEPS + f"select {ENRICHED_COLUMNS} from enriched")
def _(t: Tables):
    return flat_enriched(t.enriched())


@query("enrich_titles_joined", Q.ENRICH_STEPS + f"select {ENRICHED_COLUMNS} from enriched")
def _(t: Tables):
    return flat_enriched(t.joined().enriched())


@query("badge_tags", """
select report_id, coalesce((select string_agg(x, '|' order by i) from (select unnest(tags) as x, generate_subscripts(tags, 1) as i)
 where x <> coalesce(sector, '') and not coalesce(list_contains(stock_names, x), false)), '') as badges
from reports where tags is not null""")
def _(t: Tables):
    badges = T.badge_tags(F.col("tags"), F.col("sector"), F.col("stock_names"))
    return t.reports.where("tags is not null").select("report_id", bar(badges).alias("badges"))


# ---- structured fields -------------------------------------------------------------

@query("tickers_direct", Q.TITLES + r"select report_id, unnest(regexp_extract_all(title, '\((\d{6})\)', 1)) as ticker from titles")
def _(t: Tables):
    return stripped(t).select("report_id", F.explode(P.direct_tickers(F.col("title"))).alias("ticker"))


_TICKER_STEPS = Q.ENTITY_STEPS + Q.TICKERS


@query("tickers_by_name", _TICKER_STEPS + every_title(
    "select report_id, string_agg(distinct code, '|' order by code) as tickers from claimed group by report_id", "tickers"))
def _(t: Tables):
    codes = F.array_sort(F.array_distinct(P.claimed_tickers(F.col("title"), F.col("lex"))))
    return with_lexicon(t).select("report_id", bar(codes).alias("tickers"))


@query("tickers_from_entities", _TICKER_STEPS + "select distinct report_id, code as ticker from from_names")
def _(t: Tables):
    codes = P.entity_tickers(F.col("title"), F.col("names"), F.col("lex"))
    return with_names(t).select("report_id", F.explode(F.array_distinct(codes)).alias("ticker"))


def with_tickers(t: Tables) -> DataFrame:
    codes = P.tickers(F.col("title"), F.col("names"), F.col("lex"))
    return with_names(t).withColumn("tickers", codes)


@query("tickers", _TICKER_STEPS + every_title("select report_id, tickers from ticker_lists", "tickers"))
def _(t: Tables):
    return with_tickers(t).select("report_id", bar(F.col("tickers")).alias("tickers"))


@query("merge_lexicons", """
, promo as (select p_name as word, 'P' || cast(min(p_partkey) as varchar) as code from part group by p_name)
select word, code, 0 as source from promo union all
select word, code, 1 as source from lexicon where word not in (select word from promo)""")
def _(t: Tables):
    promo = t.base("part").groupBy(F.col("p_name").alias("word"))
    first = promo.agg(F.concat(F.lit("P"), F.min("p_partkey").cast("string")).alias("code")).withColumn("rank", F.lit(0))
    second = t.view("lexicon").select(F.col("pos").alias("rank"), "word", "code")
    return E.merge_lexicons(first, second).select("word", "code", "source")


def _price(t: Tables, compat: bool) -> DataFrame:
    return stripped(t).withColumn("p", P.price_target(F.col("title"), compat))


@query("price_target", Q.TITLES + Q.price() + "select report_id, raw, action from price")
def _(t: Tables):
    return _price(t, False).select("report_id", "p.raw", "p.action")


@query("price_target_compat", Q.TITLES + Q.price(True) + "select report_id, raw, action from price")
def _(t: Tables):
    return _price(t, True).select("report_id", "p.raw", "p.action")


@query("price_normalise", Q.TITLES + Q.price() + "select report_id, target_price from price")
def _(t: Tables):
    return _price(t, False).select("report_id", P.price_value(F.col("p.raw")).alias("target_price"))


@query("revision_type", Q.TITLES + Q.price() + "select report_id, revision_type from price")
def _(t: Tables):
    return _price(t, False).select("report_id", P.revision_type(F.col("p.action")).alias("revision_type"))


@query("rating", Q.TITLES + Q.RATING + "select report_id, rating from ratings")
def _(t: Tables):
    return stripped(t).select("report_id", P.rating(F.col("title")).alias("rating"))


SPLIT_SQL = r"""
, authors as (
 select report_id, firm_nm, name, pos from (
  select report_id, firm_nm, unnest(parts) as name, generate_subscripts(parts, 1) as pos from (
   select report_id, firm_nm, string_split_regex(regexp_replace(coalesce(writer, ''),
    '(?i)\s*(?:책임연구원|선임연구원|수석연구원|연구원|애널리스트|선임|책임|위원|수석|Analyst)', '', 'g'), '[,/\\|&+\s]+') as parts from reports)
 ) where length(name) between 2 and 10
)
"""


@query("split_analysts", SPLIT_SQL + "select report_id, name, row_number() over (partition by report_id order by pos) as nth from authors")
def _(t: Tables):
    rows = t.reports.select("report_id", F.posexplode(P.split_analysts(F.col("writer"))).alias("nth", "name"))
    return rows.select("report_id", "name", (F.col("nth") + 1).cast("bigint").alias("nth"))


@query("report_type", _TICKER_STEPS + Q.REPORT_TYPE + "select report_id, report_type from report_types")
def _(t: Tables):
    return with_tickers(t).select("report_id", P.report_type(F.col("title"), F.col("tickers")).alias("report_type"))


# ---- dictionaries that grow with the tables --------------------------------------------

_MENTIONED = every_title("select report_id, string_agg(name, '|' order by i) as stock_names from names group by report_id", "stock_names")


@query("entity_mentions_companies", of_companies(Q.ENTITY_STEPS + _MENTIONED))
def _(t: Tables):
    own = t.companies()
    found = E.entity_mentions(own.titles.fillna("", ["article_title"]), own.lexicon, tasks=own.tasks)
    return found.select("report_id", bar(F.col("stock_names")).alias("stock_names"))


@query("sector_by_keyword_companies", of_companies(Q.TITLES + Q.word_sector() + every_title("select report_id, sector from word_sector", "sector", "null")))
def _(t: Tables):
    return _by_word(t.companies(), False)


@query("tickers_companies", of_companies(_TICKER_STEPS + every_title("select report_id, tickers from ticker_lists", "tickers")))
def _(t: Tables):
    return with_tickers(t.companies()).select("report_id", bar(F.col("tickers")).alias("tickers"))


@query("enrich_titles_companies", of_companies(Q.ENRICH_STEPS + f"select {ENRICHED_COLUMNS} from enriched"))
def _(t: Tables):
    own = t.companies()
    return flat_enriched(own.enriched())

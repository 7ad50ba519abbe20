"""Queries of the table steps: matching, merging, dimensions, pages, answers, quality."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.lists import bar
from ..functions.spread import spread
from ..operators import answers as A
from ..operators import candidates as C
from ..operators import dimensions as G
from ..operators import enrich as N
from ..operators import matching as M
from ..operators import merging as U
from ..operators import pages as H
from ..operators import quality as V
from ..session import shared_dir
from . import steps as Q
from .catalog import Tables, query
from .titles import SPLIT_SQL, UNTAGGED, flat_enriched, sources

# ---- matching ----------------------------------------------------------------------


def match_sql(compat: bool, where: str = "true") -> str:
    if compat:
        gap = "cast(r.reg_dt as int) - cast(replace(s.report_date, '.', '') as int)"
    else:
        gap = "date_diff('day', strptime(s.report_date, '%Y.%m.%d'), strptime(r.reg_dt, '%Y%m%d'))"
    return f"""
, pairs as (
 select r.report_id, s.summary_id, abs({gap}) as gap from reports r join summaries s
  on r.firm_nm = s.provider and contains(r.article_title, s.company_name)
  and (starts_with(s.author, replace(r.writer, ', ', '.')) or r.writer is null or r.writer = '')
  and {gap} between -3 and 5
 where r.linked_summary_id is null and s.company_name <> '' and {where}
)
, matched as (
 select report_id, summary_id, cast(gap as bigint) as gap, count(*) over (partition by report_id) as n_fitting,
  row_number() over (partition by report_id order by gap, summary_id) as i from pairs
)
"""


_MATCHED = "select report_id, summary_id, gap, n_fitting from matched where i = 1"


def _matches(df: DataFrame) -> DataFrame:
    return df.select("report_id", "summary_id", F.col("gap").cast("bigint").alias("gap"), "n_fitting")


@query("match_summaries", match_sql(False, "r.reg_dt = '20001007'") + _MATCHED)
def _(t: Tables):
    return _matches(M.match_summaries(t.reports, t.summaries, "20001007", "20001007"))


@query("match_summaries_compat", match_sql(True) + _MATCHED)
def _(t: Tables):
    return _matches(M.match_summaries(t.reports, t.summaries, compat=True))


@query("match_tiebreak", match_sql(False) + _MATCHED)
def _(t: Tables):
    return _matches(M.match_summaries(t.reports, t.summaries))


@query("match_backlog", match_sql(False, "r.reg_dt between '20010204' and '20010802'") + _MATCHED)
def _(t: Tables):
    return _matches(M.match_backlog(t.reports, t.summaries, today="20010803"))


@query("link_reports", match_sql(False) + """
select r.report_id, coalesce(r.linked_summary_id, m.summary_id) as linked_summary_id
from reports r left join (select report_id, summary_id from matched where i = 1) m using (report_id)""")
def _(t: Tables):
    found = M.match_summaries(t.reports, t.summaries)
    return M.link_reports(t.reports, found).select("report_id", "linked_summary_id")


@query("propagate_pdf_url", """
, targets as (select summary_id from summaries where pdf_url is null or pdf_url = '')
, urls as (
 select linked_summary_id as summary_id, arg_max(telegram_url, report_id) as url from reports
 where linked_summary_id in (select summary_id from targets) and telegram_url is not null and telegram_url <> '' group by 1
)
select s.summary_id, coalesce(u.url, s.pdf_url) as pdf_url from summaries s left join urls u using (summary_id)""")
def _(t: Tables):
    return M.propagate_pdf_url(t.summaries, t.reports).select("summary_id", "pdf_url")


# ---- dimensions ----------------------------------------------------------------------
# The analysts already known are those the summaries name.

_KNOWN_ANALYSTS = """
, known_people as (
 select distinct name, sec_firm_order from (
  select f.sec_firm_order, unnest(string_split(string_split(s.author, ' ')[1], '.')) as name
  from summaries s join firms f on f.firm_nm = s.provider)
)
, old_analysts as (
 select cast(row_number() over (order by name, sec_firm_order) as bigint) as analyst_id, name, sec_firm_order from known_people
)
"""
_ANALYSTS = SPLIT_SQL + _KNOWN_ANALYSTS + """
, pairs as (select a.report_id, a.name, f.sec_firm_order from authors a join firms f on f.firm_nm = a.firm_nm)
, fresh as (select distinct name, sec_firm_order from pairs except select name, sec_firm_order from old_analysts)
, analysts as (
 select * from old_analysts union all
 select cast((select count(*) from old_analysts) + row_number() over (order by name, sec_firm_order) as int), name, sec_firm_order from fresh
)
"""
# The bridge already holds the reports of one year.
_BRIDGE = _ANALYSTS + """
, bridge as (
 select distinct p.report_id, a.analyst_id from pairs p join analysts a on a.name = p.name and a.sec_firm_order = p.sec_firm_order
)
"""


def old_analysts(t: Tables) -> DataFrame:
    names = F.explode(F.split(F.split("author", " ")[0], "\\."))
    people = t.summaries.select(F.col("provider").alias("firm_nm"), names.alias("name"))
    people = people.join(t.view("firms"), "firm_nm").select("name", "sec_firm_order").distinct()
    none = t.spark.createDataFrame([], "analyst_id bigint, name string, sec_firm_order int")
    return G._next_ids(people, none, "analyst_id", ["name", "sec_firm_order"]).select("analyst_id", "name", "sec_firm_order")


def all_analysts(t: Tables) -> DataFrame:
    return G.upsert_analysts(t.reports, t.view("firms"), old_analysts(t))


def full_bridge(t: Tables, analysts: DataFrame) -> DataFrame:
    none = t.spark.createDataFrame([], "report_id bigint, analyst_id bigint")
    first = G.report_analyst_bridge(t.reports.where("reg_dt like '1998%'"), t.view("firms"), analysts, none)
    return G.report_analyst_bridge(t.reports, t.view("firms"), analysts, first)


@query("upsert_analysts", _ANALYSTS + "select analyst_id, name, sec_firm_order from analysts")
def _(t: Tables):
    return all_analysts(t)


@query("report_analyst_bridge", _BRIDGE + "select report_id, analyst_id from bridge")
def _(t: Tables):
    return full_bridge(t, all_analysts(t))


@query("report_analysts_read", _BRIDGE + """
select b.report_id, string_agg(distinct a.name, '|' order by a.name) as names
from bridge b join analysts a using (analyst_id) where b.report_id in (select report_id from reports) group by b.report_id""")
def _(t: Tables):
    analysts = all_analysts(t)
    read = M.report_analysts_read(full_bridge(t, analysts), analysts, t.reports)
    return read.select("report_id", bar(F.col("names")).alias("names"))


@query("analyst_firm_rollup", _BRIDGE + Q.TITLES + Q.price() + """
select a.name, a.sec_firm_order, count(*) as n_reports, count(p.target_price) as n_targets,
 round(sum(p.target_price) / count(p.target_price), 4) as mean_target
from bridge b join price p using (report_id) join analysts a using (analyst_id) group by a.name, a.sec_firm_order, a.analyst_id""")
def _(t: Tables):
    from .titles import P, stripped

    priced = stripped(t).select("report_id", P.price_value(P.price_target(F.col("title"))["raw"]).alias("target_price"))
    analysts = all_analysts(t)
    return G.analyst_firm_rollup(priced, full_bridge(t, analysts), analysts)


# Forecasts: what the first delivery lines say is stored, all lines come in.
_FORECASTS = """
, ranked as (
 select *, row_number() over (partition by report_id, year order by line, l_partkey, l_suppkey, sales, operating_profit, net_income) as i
 from forecast_lines
)
, old_forecasts as (
 select cast(row_number() over (order by report_id, year) as bigint) as forecast_id, report_id, year, max_sales as sales from (
  select report_id, year, max(sales) as max_sales from forecast_lines where line = 1 group by report_id, year)
)
, forecasts as (
 select forecast_id, report_id, year, sales from old_forecasts
 union all
 select cast((select count(*) from old_forecasts) + row_number() over (order by report_id, year) as int), report_id, year, sales
 from ranked r where i = 1 and not exists (select 1 from old_forecasts o where o.report_id = r.report_id and o.year = r.year)
)
"""
_VALUES = ["sales", "operating_profit", "net_income"]


def old_forecasts(t: Tables) -> DataFrame:
    first = t.view("forecast_lines").where("line = 1").groupBy("report_id", "year").agg(F.max("sales").alias("sales"))
    none = t.spark.createDataFrame([], "forecast_id bigint")
    numbered = G._next_ids(first, none, "forecast_id", ["report_id", "year"])
    return numbered.select(
        "forecast_id", "report_id", "year", F.col("sales").cast("decimal(30,4)").alias("sales"),
        *[F.lit(None).cast("decimal(30,4)").alias(c) for c in _VALUES[1:]],
    )


def all_forecasts(t: Tables) -> DataFrame:
    lines = t.view("forecast_lines").withColumns({c: F.col(c).cast("decimal(30,4)") for c in _VALUES})
    return G.upsert_forecasts(old_forecasts(t), lines, ["line", "l_partkey", "l_suppkey"])


@query("upsert_forecasts", _FORECASTS + "select forecast_id, report_id, year, cast(sales as double) as sales from forecasts")
def _(t: Tables):
    return all_forecasts(t).select("forecast_id", "report_id", "year", F.col("sales").cast("double").alias("sales"))


@query("report_forecasts_read", _FORECASTS + """
select report_id, year, cast(sales as double) as sales from forecasts where report_id in (select report_id from reports)""")
def _(t: Tables):
    read = M.report_forecasts_read(all_forecasts(t), t.reports)
    return read.select("report_id", "year", F.col("sales").cast("double").alias("sales"))


@query("forecast_consensus", Q.ENTITY_STEPS + Q.TICKERS + _FORECASTS + """
, one_ticker as (select * from claimed union select * from direct union select * from from_names)
select k.code as ticker, f.year, count(*) as n_forecasts, round(cast(sum(f.sales) as double) / count(*), 4) as mean_sales,
 round(median(cast(f.sales as double)), 4) as median_sales
from one_ticker k join forecasts f using (report_id) group by k.code, f.year""")
def _(t: Tables):
    from .titles import with_tickers

    reports = with_tickers(t).select("report_id", F.col("tickers").alias("stock_tickers"))
    return G.forecast_consensus(reports, all_forecasts(t))


# ---- pages -----------------------------------------------------------------------------

PATTERNS = (r'<section id="body">(.*?)</section>', r"<article>(.*?)</article>", r"<body>(.*?)</body>")
_CLEAN = r"trim(regexp_replace(replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '[\s\x1c-\x1f\x0b\x85\p{{Z}}]+', ' ', 'g'))"
_CONTAINER = "case " + " ".join(
    f"when regexp_matches(html, '(?s){p}') then regexp_extract(html, '(?s){p}', 1)" for p in PATTERNS
) + " end"
_CONTAINERS = f"""
, inner_html as (select report_id, firm_nm, html, {_CONTAINER} as inner_text from report_pages)
, containers as (
 select report_id, firm_nm, html, case when length(c) > 30 then c end as text
 from (select report_id, firm_nm, html, {_CLEAN.format(x="inner_text")} as c from inner_html)
)
"""
_BLOCK = r"<p>(.*?)</p>"
_BLOCKS = rf"""
, blocks as (
 select report_id, arg_min(c, k) as text from (
  select report_id, k, {_CLEAN.format(x="block")} as c from (
   select report_id, unnest(regexp_extract_all(html, '(?s){_BLOCK}', 1)) as block,
    generate_subscripts(regexp_extract_all(html, '(?s){_BLOCK}', 1), 1) as k from report_pages)
 ) where length(c) > 200 group by report_id
)
"""


@query("container_text", _CONTAINERS + "select report_id, text from containers")
def _(t: Tables):
    return t.view("report_pages").select("report_id", H.container_text(F.col("html"), PATTERNS).alias("text"))


@query("first_long_block", _BLOCKS + "select p.report_id, b.text from report_pages p left join blocks b using (report_id)")
def _(t: Tables):
    return t.view("report_pages").select("report_id", H.first_long_block(F.col("html"), _BLOCK).alias("text"))


@query("clean_markup", f"select report_id, {_CLEAN.format(x='html')} as text from report_pages")
def _(t: Tables):
    return t.view("report_pages").select("report_id", H.clean_markup(F.col("html")).alias("text"))


@query("text_gates", "select doc_id as report_id, case when length(text) > 200 then text end as text from documents")
def _(t: Tables):
    return t.base("documents").select(F.col("doc_id").alias("report_id"), H.text_gates(F.col("text"), 200).alias("text"))


_EXTRACTED = _CONTAINERS + _BLOCKS + """
, extracted as (
 select c.report_id, c.firm_nm, case when c.firm_nm = 'FIRM00' then c.text else b.text end as text
 from containers c left join blocks b using (report_id)
)
"""


def extracted(t: Tables) -> DataFrame:
    return H.extract_by_source(t.view("report_pages"), sources(t), PATTERNS, _BLOCK)


@query("extract_by_source", _EXTRACTED + "select report_id, firm_nm, text from extracted")
def _(t: Tables):
    return extracted(t).withColumnRenamed("article_text", "text")


@query("utf8_quarantine", "select r.report_id, r.lang = 'fr' as quarantined, case when r.lang <> 'fr' then d.text end as html from raw_pages r join documents d on d.doc_id = r.report_id")
def _(t: Tables):
    return H.utf8_quarantine(t.view("raw_pages")).select("report_id", "quarantined", "html")


@query("text_yield", _EXTRACTED + """
select p.firm_nm, count(e.text) as updated, count(*) as total from report_pages p join extracted e using (report_id)
where p.article_text is null or p.article_text = '' group by p.firm_nm""")
def _(t: Tables):
    waiting = t.view("report_pages").where("article_text is null or article_text = ''")
    texts = H.extract_by_source(waiting, sources(t), PATTERNS, _BLOCK)
    return H.text_yield(waiting, texts)


# ---- merging ------------------------------------------------------------------------------

_STORED = (
    "report_id, coalesce(array_to_string(tags, '|'), '-') as tags, coalesce(array_to_string(stock_names, '|'), '-') as stock_names,"
    " sector, target_price, rating, revision_type, report_type, coalesce(array_to_string(stock_tickers, '|'), '-') as stock_tickers"
)
_STORED_COLUMNS = "report_id, tags, stock_names, sector, target_price, rating, revision_type, report_type, stock_tickers".split(", ")


def stored(df: DataFrame) -> DataFrame:
    lists = {"tags", "stock_names", "stock_tickers"}
    cols = [F.coalesce(bar(F.col(c)), F.lit("-")).alias(c) if c in lists else F.col(c) for c in _STORED_COLUMNS]
    return df.select(*cols)


def updates(t: Tables) -> DataFrame:
    pending = C.pending_reports(t.reports, n=None)
    return N.flatten(t.enriched(spread(pending, "report_id", t.tasks)))


def _applied(new: list[str], base: str) -> tuple[str, str]:
    cols = ", ".join(
        f"case when e.report_id is not null then e.{c} else o.{c} end as {c}" if c in new else f"o.{c}" for c in _STORED_COLUMNS
    )
    steps = Q.ENRICH_STEPS + (
        f", upd as (select e.* from enriched e join reports r using (report_id) where {UNTAGGED.replace('tags', 'r.tags').replace('article_title', 'r.article_title')})"
    )
    return steps, f" select {cols} from ({base}) o left join upd e on e.report_id = o.report_id"


def applied_sql(new: list[str], base: str = f"select {_STORED} from reports") -> str:
    return "".join(_applied(new, base))


def applied_steps(new: list[str], base: str = f"select {_STORED} from reports") -> str:
    """The merged table as a step that more SQL can follow."""
    steps, select = _applied(new, base)
    return f"{steps}, applied as ({select}) "


@query("apply_enrichment", applied_sql(N.TAG_COLUMNS + N.PREMIUM_COLUMNS))
def _(t: Tables):
    return stored(U.apply_enrichment(t.reports, updates(t)))


@query("apply_tags_only", applied_sql(N.TAG_COLUMNS))
def _(t: Tables):
    return stored(U.apply_tags_only(t.reports, updates(t)))


@query("apply_premium_only", applied_sql(N.PREMIUM_COLUMNS))
def _(t: Tables):
    return stored(U.apply_premium_only(t.reports, updates(t)))


@query("schema_adaptive_write", applied_sql(N.TAG_COLUMNS))
def _(t: Tables):
    narrow = t.reports.drop(*N.PREMIUM_COLUMNS)
    written = U.schema_adaptive_write(narrow, updates(t))
    return stored(written.join(t.reports.select("report_id", *N.PREMIUM_COLUMNS), "report_id"))


@query("add_premium_columns", f"""
select report_id, coalesce(array_to_string(tags, '|'), '-') as tags, cast(null as bigint) as target_price, cast(null as varchar) as rating,
 cast(null as varchar) as revision_type, cast(null as varchar) as report_type, '' as stock_tickers from reports""")
def _(t: Tables):
    wide = U.add_premium_columns(t.reports.select("report_id", "tags"))
    return wide.withColumns({"tags": F.coalesce(bar(F.col("tags")), F.lit("-")), "stock_tickers": bar(F.col("stock_tickers"))})


@query("apply_article_text", _EXTRACTED + """
select p.report_id, coalesce(e.text, p.article_text) as article_text from report_pages p left join extracted e using (report_id)""")
def _(t: Tables):
    return U.apply_article_text(t.view("report_pages"), extracted(t)).select("report_id", "article_text")


@query("json_columns", """
select report_id, case when tags is null or len(tags) = 0 then '[]' else '["' || array_to_string(tags, '","') || '"]' end as tags,
 case when stock_names is null or len(stock_names) = 0 then '[]' else '["' || array_to_string(stock_names, '","') || '"]' end as stock_names,
 '[]' as stock_tickers from reports""")
def _(t: Tables):
    return U.json_columns(t.reports).select("report_id", "tags", "stock_names", "stock_tickers")


@query("batch_outcomes", Q.ENRICH_STEPS + """
select count(*) as total, count(*) filter (status = 'success' and something) as enriched,
 count(*) filter (status = 'success' and not something) as skipped, count(*) filter (status <> 'success') as errors
from (select *, tags <> '' or stock_names <> '' or sector <> '' as something from enriched)""")
def _(t: Tables):
    return U.batch_outcomes(t.enriched())


# ---- answers --------------------------------------------------------------------------------
# Fences and brackets as the labels view builds them, undone by hand.

_REPAIRED = r"""
, repaired as (
 select answer_no, regexp_replace(replace(replace(
  regexp_replace(regexp_replace(trim(answer), '(?m)^```(?:json)?\s*\n?', '', 'g'), '(?m)\n?```\s*$', '', 'g'),
  ']' || chr(10) || '[', ',' || chr(10)), '][', ','), '^\s+|\s+$', '', 'g') as text from answers
)
"""
_PARSED = _REPAIRED + """
, items as (
 select answer_no, unnest(list) as item, generate_subscripts(list, 1) - 1 as pos from (
  select answer_no, cast(case when json_type(text) = 'ARRAY' then text::json else json_extract(text, '$.results') end as json[]) as list
  from repaired where json_valid(text))
)
, parsed as (
 select answer_no, cast(pos as int) as pos, cast(json_extract_string(item, '$.id') as bigint) as id,
  case when coalesce(json_type(item, '$.tags'), 'NULL') = 'NULL' then ''
       when json_type(item, '$.tags') = 'ARRAY' then array_to_string(cast(json_extract(item, '$.tags') as varchar[]), '|')
       when json_type(item, '$.tags') = 'BOOLEAN' then case when cast(json_extract(item, '$.tags') as boolean) then 'True' else '' end
       when json_type(item, '$.tags') = 'VARCHAR' then json_extract_string(item, '$.tags')
       when json_type(item, '$.tags') = 'OBJECT' then cast(json_extract(item, '$.tags') as varchar)
       when cast(json_extract(item, '$.tags') as double) = 0 then '' else json_extract_string(item, '$.tags') end as tags,
  coalesce(json_extract_string(item, '$.sector'), '') as sector,
  coalesce(array_to_string(cast(json_extract(item, '$.stock_names') as varchar[]), '|'), '') as stock_names,
  coalesce(json_extract_string(item, '$.report_type'), '') as report_type
 from items
)
"""
_LATEST = _PARSED + """
, latest as (
 select id as report_id, tags, sector, stock_names, report_type from (
  select *, row_number() over (partition by id order by answer_no desc, pos desc) as i from parsed where id is not null and id <> 0
 ) where i = 1
)
"""


def parsed(t: Tables) -> DataFrame:
    return A.parse_answers(t.view("answers"))


def latest(t: Tables) -> DataFrame:
    return A.latest_answer_per_id(parsed(t))


@query("repair_json_text", _REPAIRED + "select answer_no, text from repaired")
def _(t: Tables):
    return t.view("answers").select("answer_no", A.repair_json_text(F.col("answer")).alias("text"))


@query("parse_answers", _PARSED + "select answer_no, pos, id, sector, report_type from parsed")
def _(t: Tables):
    shown = {c: F.coalesce(c, F.lit("")) for c in ("sector", "report_type")}
    return parsed(t).withColumns(shown).select("answer_no", "pos", "id", "sector", "report_type")


@query("coerce_tags", _PARSED + "select answer_no, pos, tags from parsed")
def _(t: Tables):
    return parsed(t).select("answer_no", "pos", bar(A.coerce_tags(F.col("tags"))).alias("tags"))


@query("latest_answer_per_id", _LATEST + "select * from latest")
def _(t: Tables):
    return latest(t).withColumns({c: bar(F.col(c)) for c in ("tags", "stock_names")})


_CANDIDATES = f"{UNTAGGED} and reg_dt >= '19970101' and (linked_summary_id is not null or report_type is not null) and (sector is null or sector = '')"
_PROMPTS = f"""
, numbered as (
 select report_id, article_title, row_number() over (order by linked_summary_id desc nulls last, report_id desc) as rn
 from reports where {_CANDIDATES}
)
, prompts as (
 select (rn - 1) // 10 as batch, report_id, rn, cast(report_id as varchar) || ': ' || article_title as line from numbered
)
"""


def prompts(t: Tables) -> DataFrame:
    return A.prompt_batches(C.model_candidates(t.reports, cutoff="19970101", n=None))


@query("prompt_batches", _PROMPTS + f"select batch, '{A.PROMPT_HEAD}' || string_agg(line, chr(10) order by rn) as prompt from prompts group by batch")
def _(t: Tables):
    return prompts(t).select("batch", "prompt")


@query("answer_coverage", _LATEST + _PROMPTS + """
select p.batch, count(l.report_id) as enriched, count(*) as total, round(count(l.report_id) * 100 / count(*), 1) as pct
from prompts p left join latest l using (report_id) group by p.batch""")
def _(t: Tables):
    return A.answer_coverage(prompts(t), latest(t))


@query("apply_model_tags", _LATEST + f"""
select o.report_id, case when l.report_id is not null then l.tags else o.tags end as tags,
 case when l.report_id is not null then l.stock_names else o.stock_names end as stock_names,
 case when l.report_id is not null then l.sector else o.sector end as sector,
 o.target_price, o.rating, o.revision_type, case when l.report_id is not null then l.report_type else o.report_type end as report_type, o.stock_tickers
from (select {_STORED} from reports) o left join latest l using (report_id)""")
def _(t: Tables):
    return stored(U.apply_model_tags(t.reports, latest(t)))


# ---- quality ----------------------------------------------------------------------------------


def all_enriched(t: Tables) -> DataFrame:
    cols = ["report_id", "firm_nm", "article_title", "tags", "stock_names", "sector"]
    return t.enriched(spread(t.reports.select(*cols), "report_id", t.tasks))


_DIFF = Q.ENRICH_STEPS + f"""
, diff as (
 select o.report_id, e.firm_nm, o.tags as old_tags, e.tags as new_tags, o.sector as old_sector, e.sector as new_sector,
  o.tags is not distinct from e.tags as tags_match, o.stock_names is not distinct from e.stock_names as stocks_match,
  o.sector is not distinct from e.sector as sector_match
 from (select {_STORED} from reports) o join enriched e using (report_id)
)
"""


@query("enrichment_diff", _DIFF + "select * from diff")
def _(t: Tables):
    diff = V.enrichment_diff(all_enriched(t))
    return diff.select(
        "report_id",
        "firm_nm",
        F.coalesce(bar(F.col("existing.tags")), F.lit("-")).alias("old_tags"),
        bar(F.col("simulated.tags")).alias("new_tags"),
        F.col("existing.sector").alias("old_sector"),
        F.col("simulated.sector").alias("new_sector"),
        "matches.*",
    )


@query("diff_summary", _DIFF + """
select firm_nm, count(*) as n, round(avg(tags_match::int), 6) as tags_rate, round(avg(stocks_match::int), 6) as stocks_rate,
 round(avg(sector_match::int), 6) as sector_rate from diff group by firm_nm""")
def _(t: Tables):
    return V.diff_summary(V.enrichment_diff(all_enriched(t)))


@query("coverage_summary", """
select total, tagged, three_or_more, untagged, round(tagged * 100.0 / total, 4) as tagged_pct, round(untagged * 100.0 / total, 4) as untagged_pct
from (select count(*) as total, count(*) filter (len(tags) > 0) as tagged, count(*) filter (len(tags) >= 3) as three_or_more,
 count(*) filter (tags is null or len(tags) = 0) as untagged from reports)""")
def _(t: Tables):
    return V.coverage_summary(t.reports)


@query("tag_topk_delta", Q.ENRICH_STEPS + """
, before as (select tag, count(*) as n from (select unnest(tags) as tag from reports) group by tag)
, after as (select tag, count(*) as n from (select unnest(string_split(tags, '|')) as tag from enriched where tags <> '') group by tag)
select coalesce(a.tag, b.tag) as tag, coalesce(b.n, 0) as n_before, coalesce(a.n, 0) as n_after, coalesce(a.n, 0) - coalesce(b.n, 0) as change
from after a full join before b on a.tag = b.tag order by n_after desc, n_before desc, tag limit 20""")
def _(t: Tables):
    return V.tag_topk_delta(t.reports.select("tags"), t.enriched().select(F.col("enriched.tags").alias("tags")))


def tokens_sql(source: str, text: str) -> str:
    part = lambda s, p: (
        f"(select * from (select token, count(*) as n, '{s}' as script from (select unnest(regexp_extract_all({text}, '{p}')) as token from {source})"
        " group by token) order by n desc, token limit 100)"
    )
    return " union all ".join(part(s, p) for s, p in V.SCRIPTS.items())


_UNCLASSIFIED = "(select * from reports where (tags is null or len(tags) = 0) and (sector is null or sector = ''))"


@query("unclassified_tokens", "select * from (" + tokens_sql(_UNCLASSIFIED, "article_title") + ")")
def _(t: Tables):
    return V.unclassified_tokens(V.unclassified(t.reports))


@query("unclassified_tokens_documents", "select * from (" + tokens_sql("documents", "text") + ")")
def _(t: Tables):
    return V.unclassified_tokens(t.base("documents"), "text")


@query("missing_keywords", ", tokens as (select * from (" + tokens_sql(_UNCLASSIFIED, "article_title") + ")) select token, n, script from tokens where token not in (select word from sector_words)")
def _(t: Tables):
    return V.missing_keywords(V.unclassified_tokens(V.unclassified(t.reports)), t.view("sector_words"))


# One batch per hour of events.
@query("throughput_log", """
, batches as (select epoch(date_trunc('hour', ts))::bigint // 3600 as batch, count(*) as n_rows, epoch_us(max(ts)) - epoch_us(min(ts)) as micros from events group by 1)
, run as (select *, sum(n_rows) over (order by batch)::bigint as rows_upto, sum(micros) over (order by batch)::bigint as micros_upto from batches)
select batch, n_rows, round(micros / 1e6, 6) as seconds, round(n_rows::double * 1000000 / nullif(micros, 0), 4) as rate,
 rows_upto, round(rows_upto::double * 1000000 / nullif(micros_upto, 0), 4) as rate_upto from run""")
def _(t: Tables):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    per_hour = t.base("events").groupBy(F.floor(micros / 3_600_000_000).alias("batch")).agg(
        F.count("*").alias("n_rows"), (F.max(micros) - F.min(micros)).alias("micros")
    )
    return V.throughput_log(per_hour)


@query("batch_outcomes_observed", Q.ENRICH_STEPS + """
select count(*) as total, count(*) filter (status = 'success' and something) as enriched,
 count(*) filter (status = 'success' and not something) as skipped, count(*) filter (status <> 'success') as errors
from (select *, tags <> '' or stock_names <> '' or sector <> '' as something from enriched)""")
def _(t: Tables):
    """The counts that writing the enrichment leaves behind."""
    seen = Observation()
    staged_folder = f"{shared_dir(t.spark)}/observed-{uuid.uuid4().hex}"
    N.flatten(U.observed_outcomes(t.enriched(), seen)).write.parquet(staged_folder)
    return t.spark.createDataFrame([tuple(seen.get[c] for c in U.OUTCOMES)], ", ".join(f"{c} bigint" for c in U.OUTCOMES))

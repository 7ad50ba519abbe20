"""SQL building blocks of the title checks (DuckDB spelling), written from the
definitions and independent of the Spark expressions."""

from __future__ import annotations

import re

from .. import rules
from ..operators import structured as P
from ..operators.entities import OPINION_WORDS

_NAME = r"가-힣A-Za-z&0-9\-"
_CODED = rf"([{_NAME}](?:[{_NAME}\s]*[{_NAME}])?)\s*\(\s*(\d{{5,6}})(?:\.[A-Z]{{2,4}})?(?:/[가-힣A-Za-z&0-9/]+)?\s*\)"
_EDGE = r"[^\p{L}\p{N}_]"
_EDGE_OF = r"[\p{L}\p{N}_]"

TITLES = r"""
, titles as (
 select report_id, firm_nm, coalesce(regexp_replace(article_title, '^\s+|\s+$', '', 'g'), '') as title,
  article_title is not null as given
 from reports
)
"""

STOP = ", stop as (select unnest([" + ", ".join(f"'{w}'" for w in rules.stop_names()) + "]) as word)\n"

CODED = rf"""
, coded as (
 select report_id, pos, code, name from (
  select report_id, pos, code, case when length(raw) > 12 then string_split_regex(raw, '\s+')[-1] else raw end as name
  from (
   select report_id, unnest(regexp_extract_all(title, '{_CODED}', 1)) as raw,
    unnest(regexp_extract_all(title, '{_CODED}', 2)) as code,
    generate_subscripts(regexp_extract_all(title, '{_CODED}', 2), 1) as pos
   from titles
  )
 ) where name <> '' and name not in (select word from stop)
)
"""

ALIAS = """
, alias as (
 select c.report_id, c.pos, arg_min(l.word, l.pos) as name
 from coded c join lexicon l on l.code = c.code and l.grp < 2 and l.word <> c.name group by c.report_id, c.pos
)
"""

BRACKET = rf"""
, bracketed as (
 select report_id, unnest(regexp_extract_all(title, '(?i)\[([가-힣A-Za-z&0-9]+)\s*/\s*(?:{OPINION_WORDS})\]', 1)) as name,
  generate_subscripts(regexp_extract_all(title, '(?i)\[([가-힣A-Za-z&0-9]+)\s*/\s*(?:{OPINION_WORDS})\]', 1), 1) as pos
 from titles
)
"""

KNOWN = rf"""
, contained as materialized (
 select t.report_id, t.title, l.pos, l.word as name from titles t join lexicon l on l.grp < 2 and contains(t.title, l.word)
)
, around as (
 select report_id, pos, name, right(piece, 1) as before, lead(left(piece, 1)) over (partition by report_id, pos order by k) as after
 from (
  select report_id, pos, name, unnest(string_split(title, name)) as piece, generate_subscripts(string_split(title, name), 1) as k
  from contained
 )
)
, known as (
 select distinct report_id, pos, name from around
 where after is not null and not regexp_matches(before, '{_EDGE_OF}') and not regexp_matches(after, '{_EDGE_OF}')
)
"""

PIECES = """
, pieces as (
 select report_id, 1 as g, pos * 2 as p, name from coded
 union all select report_id, 1, pos * 2 + 1, name from alias
 union all select report_id, 2, pos, name from bracketed
 union all select report_id, 3, pos, name from known
)
"""

NAMES = """
, names as (
 select report_id, name, row_number() over (partition by report_id order by g, p) as i from (
  select report_id, name, g, p, row_number() over (partition by report_id, name order by g, p) as d
  from pieces where name not in (select word from stop)
 ) where d = 1
)
"""

NAME_SECTOR = """
, name_sector as (
 select report_id, arg_min(s, i) as sector from (
  select n.report_id, n.i, coalesce(l.sector, w.sector) as s
  from names n left join lexicon l on l.word = n.name left join sector_words w on w.word = n.name
 ) where s is not null group by report_id
)
"""


def word_sector(compat: bool = False) -> str:
    whole = "" if compat else (
        " where not regexp_matches(word, '^[A-Za-z]{1,3}$')"
        " or regexp_matches(title, '(^|[^A-Za-z])' || word || '($|[^A-Za-z])')"
    )
    return f"""
, word_hits as materialized (
 select t.report_id, t.title, w.word, w.sector from titles t join sector_words w on contains(t.title, w.word)
)
, word_sector as (
 select report_id, sector from (
  select report_id, sector, row_number() over (partition by report_id order by length(word) desc, sector desc) as i
  from word_hits{whole}
 ) where i = 1
)
"""


SECTORS = """
, sectors as (
 select t.report_id, coalesce(n.sector, w.sector, '') as sector
 from titles t left join name_sector n using (report_id) left join word_sector w using (report_id)
)
"""


def re2(pattern: str) -> str:
    """The pattern without look-around and word edges, which RE2 lacks or reads as ASCII."""
    pattern = pattern.replace("(?<![A-Za-z])", "(?:^|[^A-Za-z])").replace("(?![A-Za-z])", "(?:$|[^A-Za-z])")
    return re.sub(r"\\b(.*?)\\b", lambda m: f"(?:^|{_EDGE}){m[1]}(?:$|{_EDGE})", pattern)


def _case(rule) -> str:
    return f"case when regexp_matches(title, '(?i){re2(rule.pattern)}') then '{rule.label}' end"


LABELS = (
    ", labels as (select report_id, label, min(ord) as ord from (\n"
    " select report_id, unnest(hits) as label, generate_subscripts(hits, 1) as ord from (\n"
    "  select report_id, list_value(" + ",\n   ".join(_case(r) for r in rules.tag_rules()) + ") as hits from titles)\n"
    ") where label is not null group by report_id, label)\n"
)

ACTIONS = (
    ", actions as (select report_id, coalesce(" + ",\n ".join(_case(r) for r in rules.action_rules()) + ") as action from titles)\n"
)

MERGED = """
, merged as (
 select report_id, label, ord from labels
 union all
 select a.report_id, a.action, 0 from actions a where a.action is not null
  and not exists (select 1 from labels l where l.report_id = a.report_id and l.label = a.action)
)
"""

NO_SECTOR = """
, no_sector as (
 select m.report_id, m.label, m.ord from merged m join sectors s using (report_id)
 where s.sector = '' or not (m.label = s.sector or (length(m.label) >= 2 and contains(s.sector, m.label)))
)
"""

NO_NAMES = """
, no_names as (
 select k.report_id, k.label, k.ord from no_sector k where not exists (
  select 1 from names n where n.report_id = k.report_id and (n.name = k.label
   or (length(k.label) >= 2 and (contains(n.name, k.label) or contains(k.label, n.name)))))
)
"""

TAGGED = """
, tagged as (
 select report_id, label, row_number() over (partition by report_id order by ord) as i from (
  select report_id, label, ord from no_names
  union all
  select distinct n.report_id, '기업 분석', 1000 from names n
  where not exists (select 1 from no_names k where k.report_id = n.report_id and k.label = '기업 분석')
 )
)
"""

ENTITY_STEPS = STOP + TITLES + CODED + ALIAS + BRACKET + KNOWN + PIECES + NAMES
SECTOR_STEPS = ENTITY_STEPS + NAME_SECTOR + word_sector() + SECTORS
TAG_STEPS = SECTOR_STEPS + LABELS + ACTIONS + MERGED + NO_SECTOR + NO_NAMES + TAGGED

# No title holds two product names side by side, so of nested names only the
# longest claims, and blanking it shows what is left for the short last words.
TICKERS = r"""
, all_full_names as (
 select t.report_id, l.word, l.code from titles t join lexicon l on l.grp < 2 and contains(t.title, l.word)
)
, full_names as (
 select a.* from all_full_names a where not exists (
  select 1 from all_full_names b where b.report_id = a.report_id and length(b.word) > length(a.word) and contains(b.word, a.word))
)
, rest as (
 select t.report_id, coalesce(replace(t.title, any_value(f.word), '#'), t.title) as title
 from titles t left join full_names f using (report_id) group by t.report_id, t.title
)
, claimed as (
 select report_id, code from full_names
 union
 select r.report_id, l.code from rest r join lexicon l on l.grp = 2 and contains(r.title, l.word)
)
, direct as (
 select report_id, unnest(regexp_extract_all(title, '\((\d{6})\)', 1)) as code from titles
)
, from_names as (
 select n.report_id, l.code from names n join titles t using (report_id) join lexicon l on l.word = n.name
 where not contains(t.title, n.name)
)
, ticker_lists as (
 select report_id, string_agg(code, '|' order by code) as tickers, count(*) as n from (
  select * from claimed union select * from direct union select * from from_names
 ) group by report_id
)
"""


def price(compat: bool = False) -> str:
    p, a = P.PRICE_COMPAT if compat else P.PRICE_FIXED, P.ACTION
    labelled = rf"{P.PRICE_LABEL}({p})\s*원?\s*(?:으로\s*)?\s*({a})?"
    bare = rf"({p})\s*원\s*(?:으로\s*)?\s*({a})"
    return rf"""
, price as (
 select report_id, raw, action,
  case when value >= 1000 then value end as target_price,
  case when action like '%상향%' then 'UPGRADE' when action like '%하향%' then 'DOWNGRADE'
       when action like '%신규%' or action like '%제시%' then 'NEW' else 'MAINTAIN' end as revision_type
 from (
  select report_id, raw, action,
   try_cast(replace(regexp_replace(raw, '[,\s]', '', 'g'), '만', '') as bigint) * case when raw like '%만%' then 10000 else 1 end as value
  from (
   select report_id,
    nullif(case when lab then regexp_extract(title, '{labelled}', 1) else regexp_extract(title, '{bare}', 1) end, '') as raw,
    nullif(case when lab then regexp_extract(title, '{labelled}', 2) else regexp_extract(title, '{bare}', 2) end, '') as action
   from (select *, regexp_matches(title, '{labelled}') as lab from titles)
  )
 )
)
"""


def _among(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


RATING = f"""
, ratings as (
 select report_id, case when w in ({_among(P.RATINGS["HOLD"])}) then 'HOLD' when w in ({_among(P.RATINGS["SELL"])}) then 'SELL' else 'BUY' end as rating
 from (select report_id, upper(regexp_extract(title, '(?i)({P.OPINION})', 1)) as w from titles)
)
"""


def _has(words) -> str:
    return f"regexp_matches(u, '{'|'.join(words)}')"


REPORT_TYPE = f"""
, report_types as (
 select t.report_id, case
  when coalesce(k.n, 0) > 0 then 'COMPANY'
  when {_has(P.MACRO_WORDS)}
  then case when {_has(P.QUANT_WORDS)} then 'QUANT' when {_has(P.STRATEGY_WORDS)} then 'STRATEGY' else 'MACRO' end
  when {_has(P.INDUSTRY_WORDS)} then 'INDUSTRY'
  when {_has(P.MACRO_FALLBACK_WORDS)} then 'MACRO' else 'INDUSTRY' end as report_type
 from (select *, upper(title) as u from titles) t left join ticker_lists k using (report_id)
)
"""

ENRICH_STEPS = TAG_STEPS + TICKERS + price() + RATING + REPORT_TYPE + """
, enriched as (
 select t.report_id, t.firm_nm, t.title, t.given,
  coalesce((select string_agg(label, '|' order by i) from tagged g where g.report_id = t.report_id and g.i <= 8), '') as tags,
  coalesce((select string_agg(name, '|' order by i) from names n where n.report_id = t.report_id and n.i <= 5), '') as stock_names,
  s.sector, a.action as action_type, case when t.given then 'success' else 'error' end as status, 'rule-based' as model,
  case when not t.given then 'null title' when t.title = '' then 'no title' end as note,
  p.target_price, p.revision_type, r.rating, y.report_type, coalesce(k.tickers, '') as stock_tickers
 from titles t join sectors s using (report_id) join actions a using (report_id) join price p using (report_id)
  join ratings r using (report_id) join report_types y using (report_id) left join ticker_lists k using (report_id)
)
"""

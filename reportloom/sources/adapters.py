"""Report-shaped views over the star-schema test tables.

One SQL text serves both engines, so the checks start from equal inputs. Braces
name the base tables; ``$list``, ``$none``, ``$text`` and ``$bytes`` stand for the
few spellings that differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_REPORTS = """
select b.*,
 case when report_id % 5 = 1 then $list('매수 의견', '실적 전망')
      when report_id % 5 = 2 then $list('기업 분석', '목표주가 상향', '중립 의견')
      when report_id % 5 = 3 then $none end as tags,
 case when report_id % 5 in (1, 2) then $list(p_name) when report_id % 5 = 3 then $none end as stock_names,
 case when report_id % 5 = 1 then p_type when report_id % 5 = 2 then '' end as sector,
 case when report_id % 5 = 1 then cast(50000 as bigint) end as target_price,
 case when report_id % 5 = 1 then 'BUY' end as rating,
 case when report_id % 5 = 1 then 'MAINTAIN' end as revision_type,
 case when report_id % 10 = 4 then 'COMPANY' when report_id % 5 = 1 then 'INDUSTRY' end as report_type,
 $none as stock_tickers,
 case when report_id % 4 in (1, 2) then report_id - report_id % 4 end as linked_summary_id,
 case when report_id % 6 = 2 then '' else 'https://t.example/' || cast(report_id as $text) end as telegram_url
from (
 select o.o_orderkey as report_id, 'K' || cast(o.o_orderkey as $text) as key,
  'FIRM' || lpad(cast(o.o_custkey % 23 as $text), 2, '0') as firm_nm,
  case when o.o_orderkey % 3 = 0 then ''
       else 'AN' || cast(o.o_custkey % 97 as $text) || ', BN' || cast(o.o_custkey % 89 as $text) end as writer,
  replace(cast(cast(o.o_orderdate as date) as $text), '-', '') as reg_dt,
  case when o.o_orderkey % 101 = 100 then '   ' when o.o_orderkey % 103 = 102 then null
       when o.o_orderkey % 107 = 106 then ''
   else case cast(o.o_orderkey % 6 as int)
   when 0 then p.p_name || ' (' || lpad(cast(p.p_partkey as $text), 6, '0') || '): 목표가 ' || cast(100 + o.o_orderkey % 800 as $text) || ',000원 상향, 투자의견 매수'
   when 1 then p.p_name || ': 목표주가 ' || cast(1 + o.o_orderkey % 90 as $text) || '만 원으로 하향, HOLD'
   when 2 then 'Daily Brief: FOMC 금리 ' || p.p_type
   when 3 then '[' || replace(p.p_brand, '#', '') || '/Buy] ' || p.p_name || ' Preview'
   when 4 then p.p_type || ' 산업 동향 ' || p.p_name || ' vs ' || p.p_brand
   else case when o.o_orderkey % 4 = 1 then p.p_name || ' 목표가 ' || cast(90000 + o.o_orderkey % 997 as $text) || '원 하향'
        else 'misc note ' || cast(o.o_orderkey as $text) end end end as article_title,
  p.p_name, p.p_type
 from (select o.*, o.o_orderkey % (select count(*) from {part}) as slot from {orders} o) o
 join {part} p on p.p_partkey = o.slot
) b
"""

_SUMMARIES = """
select o.o_orderkey as summary_id, 'FIRM' || lpad(cast(o.o_custkey % 23 as $text), 2, '0') as provider,
 replace(cast(cast(o.o_orderdate as date) + (cast(o.o_orderkey % 9 as int) - 4) as $text), '-', '.') as report_date,
 p.p_name as company_name,
 'AN' || cast(o.o_custkey % 97 as $text) || '.BN' || cast(o.o_custkey % 89 as $text) || ' team' as author,
 case when o.o_orderkey % 12 = 0 then '' when o.o_orderkey % 12 = 4 then null
      else 'https://pdf.example/' || cast(o.o_orderkey as $text) end as pdf_url
from (select o.*, o.o_orderkey % (select count(*) from {part}) as slot from {orders} o) o
 join {part} p on p.p_partkey = o.slot
where o.o_orderkey % 4 = 0
"""

_PAGES = """
select page_id as report_id, 'FIRM' || lpad(cast(page_id % 2 as $text), 2, '0') as firm_nm, url as article_url,
 page_id % 7 as save_rank, case when page_id % 5 = 0 then 'done' when page_id % 5 = 1 then '' end as article_text, html
from {pages}
"""

_ANSWERS = """
select doc_id as answer_no, case when doc_id % 4 = 0 then repeat(chr(96), 3) || 'json' || chr(10) else '' end
 || case when doc_id % 7 = 0 then chr(123) || '"results":' else '' end
 || '[' || chr(123) || '"id":' || cast(doc_id as $text) || ',"tags":'
 || case cast(doc_id % 11 as int) when 0 then '["a","b"]' when 1 then '"a"' when 2 then '7' when 3 then '""' when 4 then '"0"' when 5 then '"false"'
      when 6 then 'true' when 7 then 'false' when 8 then '0' when 9 then chr(123) || '"k":1' || chr(125) else 'null' end
 || ',"sector":"s' || cast(quality as $text) || '","stock_names":["n' || cast(toxic as $text) || '"],"report_type":"MACRO"' || chr(125)
 || case when doc_id % 3 = 0 then ']' || chr(10) || '[' else ',' end
 || chr(123) || '"id":' || cast(doc_id - doc_id % 2 as $text) || ',"tags":["late"],"sector":"t' || cast(doc_id % 3 as $text) || '"' || chr(125) || ',' || chr(123) || '"id":0,"tags":["x"]' || chr(125) || ']'
 || case when doc_id % 7 = 0 then chr(125) else '' end
 || case when doc_id % 4 = 0 then chr(10) || repeat(chr(96), 3) else '' end as answer
from {labels}
"""

# Name table: every product name and, later in order, its upper-case alias with
# the same code; the last word of a name has a code but is no company name.
_LEXICON = """
select cast(row_number() over (order by grp, word) as int) as pos, grp, word, code, sector from (
 select 0 as grp, p_name as word, lpad(cast(min(p_partkey) as $text), 6, '0') as code,
  case when p_name like '%ring' then '실적 전망/리뷰' when p_name like '%rod' then '실적'
       when p_name like '%bolt' then '매수 의견' when p_name like 'red%' then 'RED' end as sector
 from {part} group by p_name
 union all
 select 1 as grp, upper(p_name) as word, lpad(cast(min(p_partkey) as $text), 6, '0') as code, cast(null as $text) as sector
 from {part} group by p_name
 union all
 select 2 as grp, split_part(p_name, ' ', 2) as word, 'G' || lpad(cast(min(p_partkey) as $text), 5, '0') as code,
  cast(null as $text) as sector
 from {part} group by split_part(p_name, ' ', 2)
) n
"""

_SECTOR_WORDS = """
select word, max(sector) as sector from (
 select p_type as word, 'TYPE ' || p_type as sector from {part} group by p_type
 union all
 select split_part(p_name, ' ', 2) as word, 'GOODS ' || split_part(p_name, ' ', 2) as sector
 from {part} group by split_part(p_name, ' ', 2)
 union all
 select * from (values ('FOMC', 'TEST RATES'), ('금리', 'TEST RATES AND MORE'), ('ai', 'TEST SHORT'), ('vs', 'TEST SHORT')) s(word, sector)
) w group by word
"""

# A company table that grows with the data: customers, suppliers (names nested in longer ones) and products by key, with
# ticker codes; and titles that name them.
_COMPANY_LEXICON = """
select cast(row_number() over (order by grp, word) as int) as pos, grp, word, code, sector from (
 select 0 as grp, 'Cust' || lpad(cast(c_custkey as $text), 6, '0') as word, lpad(cast(c_custkey as $text), 6, '0') as code,
  case when c_custkey % 3 = 0 then c_mktsegment end as sector from {customer}
 union all
 select 1 as grp, 'Supp ' || cast(s_suppkey as $text) as word, '9' || lpad(cast(s_suppkey as $text), 5, '0') as code, cast(null as $text) as sector from {supplier}
 union all
 select 2 as grp, 'PK' || lpad(cast(p_partkey as $text), 6, '0') as word, 'P' || lpad(cast(p_partkey as $text), 5, '0') as code, cast(null as $text) as sector from {part}
) n
"""

_COMPANY_WORDS = """
select word, max(sector) as sector from (
 select 'Cust' || lpad(cast(c_custkey as $text), 6, '0') as word, 'SEG ' || c_mktsegment as sector from {customer} where c_custkey % 2 = 1
 union all
 select 'Supp ' || cast(s_suppkey as $text) as word, 'SUPPLY ' || cast(s_nationkey as $text) as sector from {supplier}
) w group by word
"""

_COMPANY_REPORTS = """
select report_id, 'FIRM' || lpad(cast(report_id % 23 as $text), 2, '0') as firm_nm,
 case when report_id % 101 = 100 then null
 else case cast(report_id % 6 as int)
 when 0 then 'Cust' || c0 || ' (' || c0 || '): 목표가 ' || cast(100 + report_id % 800 as $text) || ',000원 상향, 투자의견 매수'
 when 1 then 'Cust' || c0 || ' vs ' || supp || ' 산업 동향'
 when 2 then 'Al' || c0 || '(' || c0 || '.KS) Al' || c1 || '(' || c1 || '.KS) Al' || c2 || '(' || c2 || '.KS) Al' || c3 || '(' || c3
  || '.KS) Al' || c4 || '(' || c4 || '.KS) Al' || c5 || '(' || c5 || '.KS)'
 when 3 then '[' || 'Cust' || c1 || '/Buy] PK' || c2 || ' Preview'
 when 4 then 'Daily Brief ' || supp || 'x, Cust' || c0
 else 'Cust' || c0 || ', Cust' || c1 || ', Cust' || c2 || ', Cust' || c3 || ', Cust' || c4 || ', Cust' || c5 || ' HOLD' end end as article_title
from (
 select o_orderkey as report_id, lpad(cast(o_custkey as $text), 6, '0') as c0, lpad(cast(o_custkey + 1 as $text), 6, '0') as c1, lpad(cast(o_custkey + 2 as $text), 6, '0') as c2,
  lpad(cast(o_custkey + 5 as $text), 6, '0') as c3, lpad(cast(o_custkey + 7 as $text), 6, '0') as c4, lpad(cast(o_custkey + 9 as $text), 6, '0') as c5,
  'Supp ' || cast(o_orderkey % 1009 as $text) as supp
 from {orders}
) o
"""

_FIRMS = """
select 'FIRM' || lpad(cast(n_nationkey as $text), 2, '0') as firm_nm, cast(n_nationkey as int) as sec_firm_order
from {nation}
"""

# Documents as byte strings; every French one ends in a torn character.
_RAW_PAGES = """
select doc_id as report_id, lang, $bytes(text) || unhex(case when lang = 'fr' then 'EA' else '' end) as html_bytes from {documents}
"""

_FORECASTS = """
select l_orderkey as report_id, cast(year(l_shipdate) as int) as year, l_linenumber as line,
 cast(l_extendedprice as decimal(18,2)) as sales, cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as operating_profit,
 cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as net_income,
 l_partkey, l_suppkey
from {lineitem}
"""

VIEWS = {
    "reports": _REPORTS,
    "summaries": _SUMMARIES,
    "report_pages": _PAGES,
    "answers": _ANSWERS,
    "lexicon": _LEXICON,
    "sector_words": _SECTOR_WORDS,
    "company_lexicon": _COMPANY_LEXICON,
    "company_words": _COMPANY_WORDS,
    "company_reports": _COMPANY_REPORTS,
    "firms": _FIRMS,
    "raw_pages": _RAW_PAGES,
    "forecast_lines": _FORECASTS,
}


def _spell(name: str, spelling: dict[str, str]) -> str:
    text = VIEWS[name]
    for token, local in spelling.items():
        text = text.replace(token, local)
    return text


def spark_sql(name: str) -> str:
    spelling = {"$text": "string", "$none": "cast(array() as array<string>)", "$list": "array", "$bytes(text)": "cast(text as binary)"}
    return _spell(name, spelling)


def duckdb_sql(name: str) -> str:
    spelling = {"$text": "varchar", "$none": "cast([] as varchar[])", "$list": "list_value", "$bytes(text)": "encode(text)"}
    return re.sub(r"\{(\w+)\}", r"\1", _spell(name, spelling))


def view(spark: SparkSession, sf_dir: str, name: str, **tables: DataFrame) -> DataFrame:
    """The named view over the parquet tables of ``sf_dir``, or over ``tables`` where given."""
    text = spark_sql(name)
    used = [t for t in BASE_TABLES if "{" + t + "}" in text]
    read = {t: tables[t] if t in tables else spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    return spark.sql(text, **read)

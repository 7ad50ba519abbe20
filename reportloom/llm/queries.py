"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, conv_repair, decontam, filter_audit, html_main, lm_score, near_dup, pieces, quality, suffix_dedup, toxicity
from .common import read
from .registry import ORACLES, QUERIES, query  # noqa: F401


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep_ids=False)


_OP10 = """
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select conv_id, turn, role, text,
    9 + 7 + 7
    + length(regexp_replace(replace(role, chr(9243), chr(9243) || '0'), '([<\\[])(\\|[^|>\\s]{1,40}\\|>|/?s>|/?INST\\]|</?SYS>>|/?SYS>>)', '\\1#\\2', 'g'))
    + length(regexp_replace(replace(text, chr(9243), chr(9243) || '0'), '([<\\[])(\\|[^|>\\s]{1,40}\\|>|/?s>|/?INST\\]|</?SYS>>|/?SYS>>)', '\\1##\\2', 'g')) as n
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(n) as bigint) as formatted_chars
from marked group by conv_id
""".replace("'\\1#\\2'", "'\\1##\\2'")


@query("op10_chat", _OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    return chat.digests(chat.format_turns(own.unionByName(more)))


#: Distinct five-word shingles of every document (fewer words: all of them as one); no words: no row.
SHINGLES_SQL = r"""
words_of as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), sh as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words_of
), sizes as (select doc_id, count(*) as n from sh group by doc_id)
"""

_OP9 = f"""
with recursive {SHINGLES_SQL}, links as (
  select a.doc_id as a, b.doc_id as b from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 85 * (max(x.n) + max(y.n) - count(*))
), reach as (
  select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a
), comp as (select a as doc_id, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join comp using (doc_id) left join sizes using (doc_id)
"""


@query("op9_near_dup", _OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


_OP5 = r"""
with words_of as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), tokens as (
  select doc_id, i, w[i] as word, case when i > 1 then w[i - 1] end as before from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from words_of)
), uni as (select word, count(*) as c from tokens group by word),
bi as (select before, word, count(*) as c from tokens where before is not null group by all),
size as (select count(*) as n from tokens),
scored as (
  select t.doc_id, case when bi.c >= 2 then ln(bi.c) - ln(p.c) when t.before is not null then ln(0.4) + ln(u.c) - ln(n) else ln(u.c) - ln(n) end as s
  from tokens t join uni u on u.word = t.word left join uni p on p.word = t.before
  left join bi on bi.before = t.before and bi.word = t.word, size
)
select d.doc_id, count(s.doc_id) as n_words, round(coalesce(sum(s), 0.0), 6) as log_score, round(avg(s), 6) as per_word
from documents d left join scored s using (doc_id) group by d.doc_id
"""


@query("op5_lm_score", _OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sums of doubles depend on their order in the last places
    return lm_score.score(read(spark, sf_dir, "documents")).withColumns({c: F.round(c, 6) for c in ("log_score", "per_word")})


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"))


_OP8 = f"""
with {SHINGLES_SQL}, item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from benchmark
), item_sh as (
  select distinct item_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from item_words
), item_sizes as (select item_id, count(*) as n from item_sh group by item_id)
select doc_id, item_id, max(n) as n_shingles, count(*) as n_shared, count(*) / max(n) as containment
from sh join item_sh using (s) join item_sizes using (item_id)
group by doc_id, item_id having count(*) >= 0.8 * max(n)
"""


@query("op8_decontam", _OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op1_ann")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "embeddings")
    return ann.neighbours(own, own.filter("vec_id % 20 = 0"))


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op3_html")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(read(spark, sf_dir, "pages"))


_OP11 = r"""
with recursive of_id as (
  select doc_id, arg_min({'text': coalesce(text, ''), 'part': coalesce(source, '')}, {'d': sha256(coalesce(text, '')), 'p': coalesce(source, '')}) as d
  from documents where doc_id is not null group by doc_id
), words_of as (
  select doc_id, d.text as text, d.part as part, regexp_extract_all(d.text, '[^\x20\x09-\x0D]+') as w from of_id
), judged as (
  select doc_id, part, (len(w) < 50)::int as a, (100 * list_unique(w) < 65 * len(w))::int as b,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int as c, regexp_matches(text, '[#$%&*|]')::int as d,
    (doc_id > min(doc_id) over (partition by text))::int as e
  from words_of
), flags as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
), cells as (
  select part, a + 2 * b + 4 * c + 8 * d + 16 * e as mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from judged left join flags using (doc_id) group by all
), orders as (
  select '' as filter_order union all select filter_order || x from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) where not contains(filter_order, x) and length(filter_order) < 5
), steps as (
  select filter_order, s::int as step, 1 << (ascii(substr(filter_order, s, 1)) - 65) as f,
    list_sum(list_transform(range(1, s), lambda i: 1 << (ascii(substr(filter_order, i, 1)) - 65))) as before
  from (select filter_order, unnest(range(1, 6)) as s from orders where length(filter_order) = 5)
), counted as (
  select part, filter_order, step, f,
    sum(n) filter ((mask & (coalesce(before, 0)::int | f)) = 0) as kept,
    sum(n) filter ((mask & f) > 0 and (mask & coalesce(before, 0)::int) = 0) as removed,
    sum(n) filter ((mask & f) > 0 and (mask & coalesce(before, 0)::int) > 0) as redundant,
    sum(n) filter (mask = f) as unique_fails,
    sum(good) filter ((mask & f) > 0 and (mask & coalesce(before, 0)::int) = 0) as good_lost,
    sum(toxic) filter ((mask & f) > 0 and (mask & coalesce(before, 0)::int) = 0) as toxic_lost
  from cells, steps group by all
)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
  coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, f), 0)::bigint as shapley
from counted
"""


@query("op11_filter_audit", _OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: crc32 of ASCII strings, and the cheapest repair row by row: the best (cost, audit, lines) to each state.
_OP12 = r"""
with recursive spoilt as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda ch: ascii(ch)::bigint)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 20 as k
  from conversations
), rows as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role,
    case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when k = 3 then [0, 1] else [0] end) as copy
  from spoilt where k <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(length(role) || ':' || role || text), copy) as i from rows
), noted as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as lastc,
    left(role, 1) as r from placed
), judged as (
  select *, case when lastc = '' then 'blank' when again then 'duplicate' when not regexp_matches(lastc, '[.!?]') then 'truncated' else '' end as fault,
    lag(r) over (partition by conv_id order by i) as before from noted
), faults as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || r not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id
), best as (
  select conv_id, 0::bigint as i, '0' as q, {'cost': 0, 'audit': '', 'lines': ''} as w from faults
  union all
  select * from (
    with once as (
      select conv_id, i, q, w from best
      union all select conv_id, i, case when q = 'u' then 'a' else 'u' end, {'cost': w.cost + 3, 'audit': w.audit || 'I', 'lines': w.lines || chr(10) || case when q = 'u' then 'assistant:' else 'user:' end} from best
    ), twice as (
      select * from once
      union all select conv_id, i, case when q = 'u' then 'a' else 'u' end, {'cost': w.cost + 3, 'audit': w.audit || 'I', 'lines': w.lines || chr(10) || case when q = 'u' then 'assistant:' else 'user:' end} from once
    ), moved as (
      select t.conv_id, j.i, t.q, {'cost': w.cost + 4, 'audit': w.audit || 'D', 'lines': w.lines} as w from twice t join judged j on j.conv_id is not distinct from t.conv_id and j.i = t.i + 1
      union all
      select t.conv_id, j.i, case when q = 'u' then 'a' else 'u' end, {'cost': w.cost + case when fault = '' then 3 else 6 end, 'audit': w.audit || 'R',
        'lines': w.lines || chr(10) || case when q = 'u' then 'assistant:' else 'user:' end || text} from twice t join judged j on j.conv_id is not distinct from t.conv_id and j.i = t.i + 1 where fault in ('', 'truncated')
      union all
      select t.conv_id, j.i, r, {'cost': w.cost + case when fault = '' then 0 else 3 end, 'audit': w.audit || 'K', 'lines': w.lines || chr(10) || role || ':' || text}
      from twice t join judged j on j.conv_id is not distinct from t.conv_id and j.i = t.i + 1 where fault in ('', 'truncated') and q || r in ('0s', '0u', 'su', 'ua', 'au')
    )
    select conv_id, i, q, min(w) as w from moved group by conv_id, i, q
  )
), ended as (
  select b.conv_id, q, w from best b join faults f on f.conv_id is not distinct from b.conv_id and f.n = b.i
  union all select b.conv_id, 'a', {'cost': w.cost + 3, 'audit': w.audit || 'I', 'lines': w.lines || chr(10) || 'assistant:'} from best b join faults f on f.conv_id is not distinct from b.conv_id and f.n = b.i where q = 'u'
  union all select b.conv_id, 'a', {'cost': w.cost + 6, 'audit': w.audit || 'II', 'lines': w.lines || chr(10) || 'user:' || chr(10) || 'assistant:'} from best b join faults f on f.conv_id is not distinct from b.conv_id and f.n = b.i where q in ('0', 's')
), done as (select conv_id, min(w) as w from ended where q in ('0', 'a') group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(w.cost, 0)::bigint as cost, coalesce(w.audit, '') as audit, sha256(coalesce(substr(w.lines, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join faults f on f.conv_id is not distinct from c.conv_id left join done d on d.conv_id is not distinct from c.conv_id
"""


@query("op12_conv_repair", _OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "conversations")
    return conv_repair.repair(conv_repair.damage(own), own)


@query("op13_pieces")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep_ids=False)

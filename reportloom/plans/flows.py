"""Queries that run a stream to its end and read back what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import candidates as C
from ..operators import enrich as N
from ..operators import matching as M
from ..operators import quality as V
from ..operators.cycle import fill_store, open_store, publish_cycle, run_cycle
from ..session import shared_dir
from ..sources import adapters as A
from ..sources import clustered as K
from ..sources import tables as S
from ..streaming import jobs as J
from . import records as R
from . import steps as Q
from .catalog import Tables, query
from .titles import ENRICHED_COLUMNS, UNTAGGED, flat_enriched


def _folders(t: Tables, name: str) -> tuple[str, str]:
    base = f"{shared_dir(t.spark)}/streams/{name}-{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/checkpoint"


def _stream(t: Tables, table: str) -> DataFrame:
    return J.file_stream(t.spark, t.sf_dir, t.base(table).schema, name_glob=f"{table}.parquet")


def report_stream(t: Tables) -> DataFrame:
    """The reports view over a stream of orders."""
    return A.view(t.spark, t.sf_dir, "reports", orders=_stream(t, "orders"))


def _finish(query, spark, path: str) -> DataFrame:
    query.awaitTermination()
    return spark.read.parquet(path)


_PENDING = Q.ENRICH_STEPS + f"select {ENRICHED_COLUMNS} from enriched where report_id in (select report_id from reports where {UNTAGGED})"


@query("stream_enrich", _PENDING)
def _(t: Tables):
    path, checkpoint = _folders(t, "enrich")
    done = J.stream_enrich(report_stream(t), t.enriched, path, checkpoint, every=None, tasks=t.tasks)
    return flat_enriched(_finish(done, t.spark, path))


@query("stream_on_arrival", Q.ENRICH_STEPS + f"""select {ENRICHED_COLUMNS} from enriched
where title <> '' and report_id in (select event_id from events)""")
def _(t: Tables):
    path, checkpoint = _folders(t, "arrival")
    keys = _stream(t, "events").select(F.concat(F.lit("K"), F.col("event_id").cast("string")).alias("key"))
    done = J.stream_on_arrival(keys, t.reports, t.enriched, path, checkpoint, every=None, tasks=t.tasks)
    # a title of blanks only is stored but has nothing to show
    return flat_enriched(_finish(done, t.spark, path).where("trim(article_title) <> ''"))


@query("stream_enrich_joined", _PENDING)
def _(t: Tables):
    path, checkpoint = _folders(t, "enrich-joined")
    done = J.stream_enrich(report_stream(t), t.joined().enriched, path, checkpoint, every=None, tasks=t.tasks)
    return flat_enriched(_finish(done, t.spark, path))


@query("stream_on_arrival_joined", Q.ENRICH_STEPS + f"""select {ENRICHED_COLUMNS} from enriched
where title <> '' and report_id in (select event_id from events)""")
def _(t: Tables):
    path, checkpoint = _folders(t, "arrival-joined")
    keys = _stream(t, "events").select(F.concat(F.lit("K"), F.col("event_id").cast("string")).alias("key"))
    done = J.stream_on_arrival(keys, t.reports, t.joined().enriched, path, checkpoint, every=None, tasks=t.tasks)
    return flat_enriched(_finish(done, t.spark, path).where("trim(article_title) <> ''"))


@query("stream_match_late", R.match_sql(False) + "select report_id, summary_id, gap, n_fitting from matched where i = 1")
def _(t: Tables):
    path, checkpoint = _folders(t, "match-late")
    late = A.view(t.spark, t.sf_dir, "summaries", orders=_stream(t, "orders"))
    done = J.stream_match_late(late, t.reports, path, checkpoint, every=None)
    return R._matches(_finish(done, t.spark, path))


@query("stream_isolation_joined", Q.ENRICH_STEPS + "select report_id, case when status = 'success' then 'good' else 'quarantine' end as route, note from enriched")
def _(t: Tables):
    path, checkpoint = _folders(t, "isolation-joined")
    done = J.stream_isolation(report_stream(t), t.joined().enriched, path, checkpoint, every=None, tasks=t.tasks)
    return _finish(done, t.spark, path).select("report_id", F.col("route").cast("string"), "enriched.note")


@query("stream_match", R.match_sql(False) + "select report_id, summary_id, gap, n_fitting from matched where i = 1")
def _(t: Tables):
    path, checkpoint = _folders(t, "match")
    done = J.stream_match(report_stream(t), t.summaries, path, checkpoint, every=None)
    return R._matches(_finish(done, t.spark, path))


@query("stream_isolation", Q.ENRICH_STEPS + "select report_id, case when status = 'success' then 'good' else 'quarantine' end as route, note from enriched")
def _(t: Tables):
    path, checkpoint = _folders(t, "isolation")
    done = J.stream_isolation(report_stream(t), t.enriched, path, checkpoint, every=None, tasks=t.tasks)
    return _finish(done, t.spark, path).select("report_id", F.col("route").cast("string"), "enriched.note")


@query("enrichment_cycle", R.applied_sql(N.TAG_COLUMNS + N.PREMIUM_COLUMNS))
def _(t: Tables):
    """Two cycles over a stored copy by month; the second has nothing left to do."""
    base = f"{shared_dir(t.spark)}/cycle-table-{uuid.uuid4().hex}"
    S.write_by_month(t.reports, f"{base}/reports")
    run = lambda: run_cycle(t.spark, f"{base}/reports", f"{base}/ledger", t.enriched, "v1")
    run()
    if run():
        raise RuntimeError("the second cycle found rows that the first had processed")
    return R.stored(t.spark.read.parquet(f"{base}/reports"))


# ---- streams that read nothing again ---------------------------------------------------


@query("stream_match_interval", R.match_sql(False) + "select report_id, summary_id, gap, n_fitting from matched where i = 1")
def _(t: Tables):
    """Reports and summaries both arrive; neither side is a stored table."""
    path, checkpoint = _folders(t, "interval")
    summaries = A.view(t.spark, t.sf_dir, "summaries", orders=_stream(t, "orders"))
    done = J.stream_match_interval(report_stream(t), summaries, path, checkpoint, every=None)
    return R._matches(M.best_pairs(_finish(done, t.spark, path)))


@query("stream_on_arrival_by_month", Q.ENRICH_STEPS + f"""select {ENRICHED_COLUMNS} from enriched
where title <> '' and report_id in (select event_id from events where event_type = 'purchase')""")
def _(t: Tables):
    """Keys arrive with their month; the stored reports are parquet by month."""
    path, checkpoint = _folders(t, "arrival-month")
    base = f"{shared_dir(t.spark)}/by-month-{uuid.uuid4().hex}"
    S.write_by_month(t.reports, base)
    months = t.base("orders").select(F.col("o_orderkey").alias("event_id"), F.date_format("o_orderdate", "yyyyMM").alias("reg_month"))
    bought = _stream(t, "events").where("event_type = 'purchase'").join(months, "event_id")
    keys = bought.select(F.concat(F.lit("K"), F.col("event_id").cast("string")).alias("key"), "reg_month")
    done = J.stream_on_arrival(keys, _by_month(t, base), t.enriched, path, checkpoint, every=None, tasks=t.tasks, month="reg_month")
    return flat_enriched(_finish(done, t.spark, path).where("trim(article_title) <> ''"))


def _by_month(t: Tables, path: str) -> DataFrame:
    """Stored reports by month; the month is text."""
    return t.spark.read.schema(S.T.StructType([*t.reports.schema.fields, S.T.StructField("reg_month", S.T.StringType())])).parquet(path)


RECORD = "report_id bigint, firm_nm string, article_title string"
_TORN = """case when report_id % 17 = 0 then left(line, length(line) div 2) when report_id % 13 = 0 then left(line, length(line) - 1) else line end as value"""


def _torn_records(t: Tables) -> str:
    """Reports as JSON lines; every seventeenth is cut in half, of the others every thirteenth lacks its last brace."""
    folder = f"{shared_dir(t.spark)}/records-{uuid.uuid4().hex}"
    lines = t.reports.select("report_id", F.to_json(F.struct("report_id", "firm_nm", "article_title")).alias("line"))
    lines.selectExpr(_TORN).write.text(folder)
    return folder


_ID = r'"report_id":(\d+)'


def _quarantine(t: Tables) -> DataFrame:
    path, checkpoint = _folders(t, "records")
    stream = J.record_stream(t.spark, _torn_records(t), RECORD)
    return _finish(J.stream_isolation(stream, t.enriched, path, checkpoint, every=None, tasks=t.tasks), t.spark, path)


@query("stream_isolation_records", Q.ENRICH_STEPS + """
select report_id, case when torn or status <> 'success' then 'quarantine' else 'good' end as route, case when torn then 'not a record' else note end as reason
from (select report_id, status, case when status <> 'success' then note end as note, report_id % 17 = 0 or report_id % 13 = 0 as torn from enriched)""")
def _(t: Tables):
    """Every line of the folder is accounted for, those that do not parse by the id in their text."""
    ids = F.coalesce(F.regexp_extract(J.CORRUPT, _ID, 1).try_cast("bigint"), "report_id").alias("report_id")
    return _quarantine(t).select(ids, F.col("route").cast("string"), "reason")


@query("quarantine_replay", Q.ENRICH_STEPS + f"""select {ENRICHED_COLUMNS} from enriched
where report_id % 13 = 0 and report_id % 17 <> 0 and status = 'success'""")
def _(t: Tables):
    """Torn records whose last brace is put back; those cut in half stay out."""
    torn = _quarantine(t).where("route = 'quarantine'")
    again = J.replayed(torn, RECORD, lambda text: F.concat(text, F.lit("}")), t.enriched, t.tasks)
    return flat_enriched(again.where("route = 'good'"))


@query("throughput_log_streamed", Q.ENRICH_STEPS + f"""
select count(*)::bigint as n_rows, count(*) filter (something)::bigint as enriched, count(*) filter (not something)::bigint as skipped, count(*)::bigint as rows_upto
from (select *, tags <> '' or stock_names <> '' or sector <> '' as something from enriched where report_id in (select report_id from reports where {UNTAGGED}))""")
def _(t: Tables):
    """What the batches of a stream logged of themselves, summed up; their seconds differ from run to run."""
    path, checkpoint = _folders(t, "logged")
    J.stream_enrich(report_stream(t), t.enriched, path, checkpoint, every=None, tasks=t.tasks, log=f"{path}-log").awaitTermination()
    log = J.batch_log(t.spark, f"{path}-log")
    sums = log.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_rows", "enriched", "skipped")])
    return sums.join(V.throughput_log(log.select("batch", "n_rows", "micros")).agg(F.max("rows_upto").cast("bigint").alias("rows_upto")))


# ---- published tables --------------------------------------------------------------------


def _published(t: Tables):
    """A store after one cycle, and the counts of that cycle."""
    store = open_store(t.spark, f"{shared_dir(t.spark)}/store-{uuid.uuid4().hex}")
    fill_store(store, t.reports.withColumn("reg_month", F.substring("reg_dt", 1, 6)))
    counts = publish_cycle(store, t.enriched, "v1")
    if publish_cycle(store, t.enriched, "v1")["total"]:
        raise RuntimeError("the second cycle found rows that the first had processed")
    return store, counts


_NEW = N.TAG_COLUMNS + N.PREMIUM_COLUMNS


@query("enrichment_cycle_published", R.applied_sql(_NEW))
def _(t: Tables):
    store, _ = _published(t)
    return R.stored(store.read("reports"))


@query("coverage_summary_by_month", R.applied_steps(_NEW) + """
select total, tagged, three_or_more, untagged, round(tagged * 100.0 / total, 4) as tagged_pct, round(untagged * 100.0 / total, 4) as untagged_pct
from (select count(*)::bigint as total, count(*) filter (n > 0)::bigint as tagged, count(*) filter (n >= 3)::bigint as three_or_more, count(*) filter (n = 0)::bigint as untagged
 from (select case when tags in ('', '-') then 0 else len(string_split(tags, '|')) end as n from applied))""")
def _(t: Tables):
    """From counts of which a cycle replaces those of touched months alone."""
    store, _ = _published(t)
    return V.coverage_of_months(store.read("coverage"))


@query("tag_topk_delta_by_month", R.applied_steps(_NEW) + """
, before as (select tag, count(*) as n from (select unnest(tags) as tag from reports) group by tag)
, after as (select tag, count(*) as n from (select unnest(string_split(tags, '|')) as tag from applied where tags not in ('', '-')) group by tag)
select coalesce(a.tag, b.tag) as tag, coalesce(b.n, 0)::bigint as n_before, coalesce(a.n, 0)::bigint as n_after, (coalesce(a.n, 0) - coalesce(b.n, 0))::bigint as change
from after a full join before b on a.tag = b.tag order by n_after desc, n_before desc, tag limit 20""")
def _(t: Tables):
    """The counts of the first version against those of the last."""
    store, _ = _published(t)
    return V.tag_topk_of_months(store.read("tag_counts", 1), store.read("tag_counts"))


@query(
    "report_by_id_clustered",
    "select i.report_id, r.firm_nm, r.article_title, case when r.report_id is null then 'report not found' else 'found' end as status"
    " from (select p_partkey * 9 as report_id from part) i left join reports r on r.report_id = i.report_id",
)
def _(t: Tables):
    """Lookups in files of disjoint id ranges; only those that may hold an asked id are opened."""
    base = f"{shared_dir(t.spark)}/clustered-{uuid.uuid4().hex}"
    K.write_clustered(t.reports.select("report_id", "firm_nm", "article_title"), base, "report_id", 32)
    ids = t.base("part").select((F.col("p_partkey") * 9).alias("report_id"))
    return C.report_by_id(K.read_by_keys(t.spark, base, ids, "report_id"), ids)

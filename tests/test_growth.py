"""Dictionaries, streams and stored tables that grow: what is read, what waits, what comes into force."""

import glob
import random
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from reportloom.functions import dictionaries as D
from reportloom.operators import enrich as N
from reportloom.operators import entities as E
from reportloom.operators import matching as M
from reportloom.operators import merging as U
from reportloom.operators import quality as V
from reportloom.operators import sectors as Z
from reportloom.operators import tags as T
from reportloom.operators.cycle import fill_store, open_store, publish_cycle, read_ledger
from reportloom.session import shared_dir
from reportloom.sources import clustered as K
from reportloom.sources import tables as S
from reportloom.sources.snapshots import Snapshots, read_if_there
from reportloom.streaming import jobs as J


def folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}".removeprefix("file:")


def tear(path):
    """Make a stored file unreadable."""
    with open(path, "wb") as f:
        f.write(b"torn")


# ---- dictionaries --------------------------------------------------------------------


def _words(rng, n):
    return sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(n)})


@pytest.mark.parametrize("bits", [D.MOST_BITS, 64])
def test_pieces_that_leave_a_text(spark, monkeypatch, bits):
    """The filter lets every piece of the dictionary pass, few others, and the result never depends on its size."""
    monkeypatch.setattr(D, "MOST_BITS", bits)
    monkeypatch.setattr(D, "LEAST_BITS", min(bits, D.LEAST_BITS))
    rng = random.Random(3)
    words = [w for w in _words(rng, 500) if len(w) > 4]
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(60)) + rng.choice(words) for _ in range(200)]
    own = D.load(spark.createDataFrame([(w,) for w in words], "word string"), 0)
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    for r in D.with_contained(df, "k", "t", own, "found").collect():
        assert sorted(e.word for e in r.found) == sorted(w for w in words if w in r.t)
    anchors = own.anchors
    used = {r["_gram"] for r in anchors.table.collect()}
    assert anchors.sizes == (5,) and len(anchors.words) * 64 <= max(bits, 16 * 2 * len(used))
    grams = sorted({t[k : k + 5] for t in texts for k in range(len(t) - 4)})
    passed = {r.g for r in spark.createDataFrame([(g,) for g in grams], "g string").where(anchors.may_have(F.col("g"))).collect()}
    assert used & set(grams) <= passed
    if bits > 64:
        assert len(passed - used) <= 0.1 * len(grams)


def test_several_dictionaries_share_a_join(spark):
    rng = random.Random(4)
    one, two = _words(rng, 40), _words(rng, 40)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(25)) for _ in range(60)] + [""]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    large = D.load(spark.createDataFrame([(w, len(w)) for w in one], "word string, n int"), 0)
    other = D.load(spark.createDataFrame([(w, w.upper()) for w in two], "word string, up string"), 0)
    empty = D.load(spark.createDataFrame([], "word string"), -1)
    small = D.load(spark.createDataFrame([("a",)], "word string"))
    got = D.with_all_contained(df, "k", "t", {"a": large, "b": other, "c": small, "d": empty})
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    for r in got.collect():
        assert sorted(e.word for e in r.a) == sorted(w for w in one if w in r.t)
        assert sorted((e.word, e.up) for e in r.b) == sorted((w, w.upper()) for w in two if w in r.t)
        assert [e.word for e in r.c] == ["a"] * ("a" in r.t) and r.d == []


@pytest.mark.parametrize("inline_rows", [D.INLINE_ROWS, 0], ids=["inline", "joined"])
def test_names_beyond_the_fifth_give_tickers_and_sectors(spark, inline_rows):
    rows = [(k, f"Nam{k}", f"{k:06d}", None, k) for k in range(1, 9)]
    words = spark.createDataFrame([("Nam1", "FIRST"), ("zzz", "Z")], "word string, sector string")
    lex = E.lexicon(spark.createDataFrame(rows, E.LEXICON_SCHEMA), inline_rows, words)
    title = " ".join(f"Al{k}({k:06d}.KS)" for k in range(1, 8))
    df = spark.createDataFrame([(1, title)], "report_id long, article_title string")
    run = lambda compat: N.enrich_titles(df, lex, Z.sector_dictionary(words, inline_rows), compat=compat).first()["enriched"]
    assert run(False).stock_tickers == [f"{k:06d}" for k in range(1, 8)]
    # names alternate between the title's own and its alias
    assert run(True).stock_tickers == ["000001", "000002"] and len(run(True).stock_names) == 5
    # an alias has the sector of the word that it is, though the title does not hold it
    assert run(False).sector == "FIRST"


@pytest.mark.parametrize("most_bits", [D.MOST_BITS, 64], ids=["filter in the plan", "filter as a table"])
def test_names_that_differ_in_their_last_signs(spark, monkeypatch, most_bits):
    """No piece stands for many words, so a text meets about the words that it holds."""
    monkeypatch.setattr(D, "MOST_BITS", most_bits)
    monkeypatch.setattr(D, "LEAST_BITS", min(most_bits, D.LEAST_BITS))
    words = [f"Cust{k:06d}" for k in range(3000)] + [f"PK{k:06d}" for k in range(3000)] + [f"{k:06d}" for k in range(3000)] + ["Supp 1", "Supp 12", "ab"]
    own = D.load(spark.createDataFrame([(w, n) for w in words for n in range(2)], "word string, n int"), 0)
    under = own.anchors.table.select("entry.word", "_gram").distinct().groupBy("_gram").count()
    assert under.where(f"count > {D.FEW}").isEmpty()
    texts = ["Cust000017, Cust002999x PK000005 (000017)", "Supp 12, ab Supp 3", "", None, "Cust00001", "0000170000170 ab ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    for limit in (10 * len(words), 0):
        monkeypatch.setattr(D, "BROADCAST_ROWS", limit)
        met = D.nominated(df, "k", "t", {"some": own}).selectExpr("sum(size(some))").first()[0]
        assert met <= 4 * sum(w in (t or "") for w in words for t in texts)
        for r in D.with_contained(df, "k", "t", own, "found").collect():
            assert sorted((e.word, e.n) for e in r.found or []) == sorted((w, n) for w in words if w in (r.t or "") for n in range(2))


def _repeated_names(rng):
    """(rank, word, code, sector, ticker_rank): few names and codes in many rows, some nested, some without rank, code or sector."""
    some = lambda x: rng.choice([x, x, None])
    words = ["Abc", "Abc Defg", "bcab", "abcabca", "K1", "Defg"]
    return [(some(k), rng.choice(words), some(f"00012{rng.randint(0, 3)}"), some(rng.choice("xy")), some(k)) for k in range(60)]


def _repeating_titles(rng):
    bits = ["Abc", "Abc Defg", "abcabcabca", " (000121)", "000122", "[K1/Buy]", "Al(000123.KS)", ", ", "bcabcab", "Abc"]
    return list(enumerate("".join(rng.choices(bits, k=rng.randint(1, 8))) for _ in range(150))) + [(900, None), (901, "")]


@pytest.mark.parametrize("few, bits", [(D.BROADCAST_ROWS, D.LEAST_BITS), (0, D.LEAST_BITS), (0, 64)])
def test_rows_of_a_repeated_name_give_what_all_of_them_give(spark, monkeypatch, few, bits):
    """Under a dictionary that is broadcast, and under a filter in the plan and one as a table."""
    monkeypatch.setattr(D, "BROADCAST_ROWS", few)
    monkeypatch.setattr(D, "LEAST_BITS", bits)
    monkeypatch.setattr(D, "MOST_BITS", min(bits, D.MOST_BITS))
    rng = random.Random(23)
    rows, titles = _repeated_names(rng), _repeating_titles(rng)
    words = spark.createDataFrame([("Abc", "of Abc"), ("Defg", "of Defg")], Z.WORD_SCHEMA.rpartition(",")[0])
    df = spark.createDataFrame(titles, "report_id long, article_title string")
    table = spark.createDataFrame(rows, E.LEXICON_SCHEMA)
    got = {}
    for size in (0, 1000):
        lex, sectors = E.lexicon(table, size, words), Z.sector_dictionary(words, size)
        names = E.entity_mentions(df, lex)
        got[size] = (
            {r.report_id: r.enriched for r in N.enrich_titles(df, lex, sectors).collect()},
            {r.report_id: r.stock_names for r in names.collect()},
        )
    assert len(got[0][0]) == len(titles)
    assert got[0] == got[1000]


def test_a_repeated_name_does_not_send_all_its_rows(spark):
    """A title gets as many rows of a name as it has places for the name, and rows of a code where it has a parenthesis."""
    rows = [(k, "Company", "000123", None, k) for k in range(40)]
    lex = E.lexicon(spark.createDataFrame(rows, E.LEXICON_SCHEMA), 0)
    titles = [(0, "Company"), (1, "Company Company Company"), (2, "000123"), (3, "(000123)"), (4, "(000123) 000123")]
    df = spark.createDataFrame(titles, "k long, t string")
    met = D.nominated(df, "k", "t", {"some": E._probe(lex)})
    assert {r.k: len(r.some) for r in met.collect()} == {0: 1, 1: 3, 3: 1, 4: 1}
    assert sorted(x.k for x in E._needed(lex.table, E.NAME_FIELDS).withColumn("k", F.col("rank")).collect()) == [0]


def test_no_side_of_the_build_of_a_dictionary_is_broadcast(spark):
    words = spark.createDataFrame([("Company", "x")], "word string, sector string")
    lex = E.lexicon(spark.createDataFrame([(1, "Company", "000123", None, 1)], E.LEXICON_SCHEMA), 0, words)
    for own in (E._probe(lex), Z.sector_dictionary(words, 0)):
        assert "Broadcast" not in own.under_pieces()._jdf.queryExecution().executedPlan().toString()


def test_titles_and_their_lists_are_not_moved_again(spark):
    """Titles that are dealt out by key meet their entries there; entries travel one by one, titles once for both sides."""
    rows = [(k, f"Company {k}", f"{k:06}", None, k) for k in range(50)]
    lex = E.lexicon(spark.createDataFrame(rows, E.LEXICON_SCHEMA), 0)
    df = spark.createDataFrame([(k, f"Company {k % 60} (0000{k % 60:02})") for k in range(90)], "report_id long, article_title string")
    out = E.entity_mentions(df.repartition(3, "report_id"), lex, tasks=3)
    assert out.count() == 90
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.split("\n") if "Exchange hashpartitioning(report_id" in x]
    assert moved and all("REPARTITION_BY_NUM" in x for x in moved), plan
    assert "isnotnull(report_id" not in plan.split("Exchange hashpartitioning(report_id")[-1], plan


def test_rules_are_data_of_the_plan(spark):
    """One test expression whatever the number of rules; a method of one test per rule is not compiled by the JVM."""
    df = T.with_rule_text(spark.createDataFrame([(1, "주간 데일리 목표가 상향"), (2, None)], "i long, t string"), "t")
    tagged = df.select("i", T.matching_labels("t").alias("tags"), T.first_label("t").alias("action"))
    assert tagged._jdf.queryExecution().optimizedPlan().toString().lower().count("contains(") <= 2
    got = {r.i: (r.tags, r.action) for r in tagged.collect()}
    assert "목표주가 상향" in got[1][0] and got[1][1] == "목표주가 상향" and got[2] == ([], None)


# ---- streams -------------------------------------------------------------------------


REPORT = "report_id long, firm_nm string, article_title string, writer string, reg_dt string, linked_summary_id long"
SUMMARY = "summary_id long, provider string, report_date string, company_name string, author string"


def test_either_side_of_a_match_may_come_late(spark):
    base = folder(spark, "interval")

    def arrive(name, schema, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/{name}")

    def run():
        streams = [J.file_stream(spark, f"{base}/{n}", spark.createDataFrame([], s).schema) for n, s in (("r", REPORT), ("s", SUMMARY))]
        query = J.stream_match_interval(*streams, f"{base}/out", f"{base}/ck", None, late_days=10)
        query.awaitTermination()
        return query

    found = lambda: sorted((r.report_id, r.summary_id, r.gap) for r in spark.read.parquet(f"{base}/out").collect())
    arrive("r", REPORT, [(1, "F", "Alpha raises", "", "20260105", None), (2, "F", "Beta", "Kim", "20260106", None), (9, "F", "Alpha", "", "20260105", 4)])
    arrive("s", SUMMARY, [(20, "F", "2026.01.05", "Beta", "Kim Lee"), (21, "F", "2026.01.05", "Beta", "Lee"), (22, "G", "2026.01.05", "Alpha", "")])
    run()
    assert found() == [(2, 20, 1)]
    # a summary after its report, a report after its summary, each after a restart
    arrive("s", SUMMARY, [(23, "F", "2026.01.08", "Alpha", ""), (24, "F", "2026.01.12", "Gamma", "")])
    run()
    arrive("r", REPORT, [(3, "F", "Gamma up", "", "20260110", None)])
    run()
    assert found() == [(1, 23, 3), (2, 20, 1), (3, 24, 2)]
    # both sides move on by a year: the state of January is given up, what comes for it then is dropped and counted
    arrive("r", REPORT, [(4, "F", "Delta", "", "20270110", None)])
    arrive("s", SUMMARY, [(25, "F", "2027.01.10", "Delta", "")])
    run()
    arrive("s", SUMMARY, [(26, "F", "2026.01.05", "Alpha", ""), (27, "F", "2027.01.11", "Delta", "")])
    last = run()
    assert found() == [(1, 23, 3), (2, 20, 1), (3, 24, 2), (4, 25, 0), (4, 27, 1)]
    states = [s for p in last.recentProgress for s in p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 9
    best = {r.report_id: (r.summary_id, r.gap, r.n_fitting) for r in M.best_pairs(spark.read.parquet(f"{base}/out")).collect()}
    assert best[4] == (25, 0, 2)


def _fitting(reports, summaries):
    """(gap, summary_id) of every fitting pair, per report id; days are days of January 2026."""
    pairs = {}
    for i, firm, title, writer, day, linked in reports:
        for j, provider, at, company, author in summaries:
            wanted, author = (writer or "").replace(", ", "."), author or ""
            if linked is None and title and company and firm is not None and firm == provider:
                if -3 <= day - at <= 5 and company in title and author.startswith(wanted):
                    pairs.setdefault(i, []).append((abs(day - at), j))
    return {i: (min(p)[1], min(p)[0], len(p)) for i, p in pairs.items()}


def _dated(rows, at, text):
    return [(*r[:at], text.format(r[at]), *r[at + 1 :]) for r in rows]


@pytest.mark.parametrize("listed", [M.LISTED, 1], ids=["listed", "by piece"])
def test_blocks_of_two_streams_match_as_their_rows_would(spark, monkeypatch, listed):
    """Rows that come twice, without firm, title, writer or author, in several micro-batches and in blocks of three rows."""
    from reportloom.functions import blocks as B

    folded, best = B.blocks, M.best_of_meetings
    monkeypatch.setattr(B, "blocks", lambda rows, by, name: folded(rows, by, name, 3))
    monkeypatch.setattr(M, "best_of_meetings", lambda met: best(met, listed))
    rng, base = random.Random(11), folder(spark, "blocks")
    names, people = ["Alpha", "Alph", "Beta One", "B", "감마", " ", "Delta Holdings", None], ["", "Kim", "Kim Lee", "Kim, Park", "Lee", None]
    title = lambda: rng.choice([None, "  ", "misc", " ".join(rng.choice([n for n in names if n]) for _ in range(2))])
    reports = [(k, rng.choice(["F", "F", "G", None]), title(), rng.choice(people), rng.randint(10, 18), rng.choice([None, None, None, 4])) for k in range(120)]
    summaries = [(k, rng.choice(["F", "F", "G", None]), rng.randint(10, 18), rng.choice(names), rng.choice(["Kim", "Kim Lee", "Kim.Park team", "", None])) for k in range(120)]
    reports, summaries = reports + reports[:20], summaries + summaries[:20]
    read = {"r": [], "s": []}
    for part in range(2):
        read["r"] += reports[part::2]
        read["s"] += summaries[part::2]
        spark.createDataFrame(_dated(reports[part::2], 4, "202601{}"), REPORT).coalesce(1).write.mode("append").parquet(f"{base}/r")
        spark.createDataFrame(_dated(summaries[part::2], 2, "2026.01.{}"), SUMMARY).coalesce(1).write.mode("append").parquet(f"{base}/s")
        streams = [J.file_stream(spark, f"{base}/{n}", spark.createDataFrame([], s).schema) for n, s in (("r", REPORT), ("s", SUMMARY))]
        J.stream_match_interval(*streams, f"{base}/out", f"{base}/ck", None).awaitTermination()
        got = {r.report_id: (r.summary_id, r.gap, r.n_fitting) for r in M.best_pairs(spark.read.parquet(f"{base}/out")).collect()}
        assert got == _fitting(read["r"], read["s"]) and got


def test_a_full_day_is_neither_kept_nor_written_as_pairs(spark):
    base, n = folder(spark, "full-day"), 200
    reports = [(k, "F", f"Alpha {k}", "", 10, None) for k in range(n)]
    summaries = [(k, "F", 10 + k % 3, "Alpha", f"Kim {k}") for k in range(n)]
    spark.createDataFrame(_dated(reports, 4, "202601{}"), REPORT).coalesce(1).write.parquet(f"{base}/r")
    spark.createDataFrame(_dated(summaries, 2, "2026.01.{}"), SUMMARY).coalesce(1).write.parquet(f"{base}/s")
    streams = [J.file_stream(spark, f"{base}/{x}", spark.createDataFrame([], s).schema) for x, s in (("r", REPORT), ("s", SUMMARY))]
    query = J.stream_match_interval(*streams, f"{base}/out", f"{base}/ck", None)
    query.awaitTermination()
    found = spark.read.parquet(f"{base}/out")
    # one row a report, and a block per side, firm and day: a summary lies under nine days, those of three days under eleven
    assert found.count() == n
    assert max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) <= 1 + 11
    got = {r.report_id: (r.summary_id, r.gap, r.n_fitting) for r in M.best_pairs(found).collect()}
    assert got == _fitting(reports, summaries) and got[5] == (0, 0, n)


def test_an_arrival_reads_its_months_alone(spark):
    base = folder(spark, "arrivals")
    rows = [(k, f"K{k}", "F", f"title {k}", f"2026{1 + k % 12:02d}05") for k in range(48)] + [(50, "K50", "F", "undated", None)]
    schema = "report_id long, key string, firm_nm string, article_title string, reg_dt string"
    S.write_by_month(spark.createDataFrame(rows, schema), f"{base}/reports")
    # whoever opens a file of another month fails
    for path in glob.glob(f"{base}/reports/reg_month=*/*.parquet"):
        if not any(m in path for m in ("202603", "202607", "HIVE_DEFAULT")):
            tear(path)
    stored = spark.read.schema(f"{schema}, reg_month string").parquet(f"{base}/reports")
    keys = [("K2", "202603"), ("K14", "202603"), ("K6", "202607"), ("K3", "202603"), ("K50", None)]
    spark.createDataFrame(keys, "key string, reg_month string").coalesce(1).write.parquet(f"{base}/keys")
    stream = J.file_stream(spark, f"{base}/keys", "key string, reg_month string")
    J.stream_on_arrival(stream, stored, lambda df: df, f"{base}/out", f"{base}/ck", None, month="reg_month").awaitTermination()
    assert sorted(r.report_id for r in spark.read.parquet(f"{base}/out").collect()) == [2, 6, 14, 50]


def _plain(df):
    status = F.when(F.col("article_title").isNull(), "error").otherwise("success")
    return df.withColumn("enriched", F.struct(F.upper("article_title").alias("t"), status.alias("status"), F.when(status == "error", "null title").alias("note")))


def test_records_that_do_not_parse_are_kept_and_replayed(spark):
    base = folder(spark, "records")
    lines = ['{"report_id":1,"article_title":"a"}', '{"report_id":2,"article_title":"b"', '{"report_id":3}', "", "not json at all", '{"report_id":"x","article_title":"c"}', '{"report_id":4,"article_title":"d"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/in")
    schema = "report_id long, article_title string"
    run = lambda: J.stream_isolation(J.record_stream(spark, f"{base}/in", schema), _plain, f"{base}/out", f"{base}/ck", None).awaitTermination()
    run()
    run()
    rows = spark.read.parquet(f"{base}/out")
    got = sorted((r[J.CORRUPT] or str(r.report_id), r.route, r.reason) for r in rows.collect())
    assert got == sorted(
        [("1", "good", None), ("4", "good", None), ("3", "quarantine", "null title")]
        + [(x, "quarantine", "not a record") for x in (lines[1], lines[4], lines[5])]
    )
    assert all(r[J.SOURCE].endswith(".txt") for r in rows.collect())
    again = J.replayed(rows, schema, lambda text: F.concat(text, F.lit("}")), _plain).collect()
    assert sorted((r.route, r.report_id or -1) for r in again) == [("good", 2), ("quarantine", -1), ("quarantine", -1)]


def test_records_without_an_id_are_dealt_out_too(spark):
    rows = [(None, f"torn {i}", "f") for i in range(400)]
    torn = spark.createDataFrame(rows, f"report_id long, {J.CORRUPT} string, {J.SOURCE} string")
    sizes = [len(p) for p in J._dealt(torn, 8).rdd.glom().collect()]
    assert sum(sizes) == 400 and max(sizes) < 100
    again = J.replayed(torn, "report_id long, article_title string", lambda text: text, _plain, tasks=8)
    assert again.rdd.getNumPartitions() == 8 and again.where("route = 'quarantine'").count() == 400


def test_tasks_of_title_work_grow_with_the_table(spark):
    from reportloom.plans import catalog

    base = folder(spark, "many")
    spark.range(2 * catalog.TASK_ROWS * spark.sparkContext.defaultParallelism + 1).withColumnRenamed("id", "o_orderkey").write.parquet(f"{base}/orders.parquet")
    assert catalog.Tables(spark, base).tasks == 3 * spark.sparkContext.defaultParallelism


def test_inline_words_are_met_without_a_walk_over_places(spark):
    words = D.from_rows(spark, [("ab", 1), ("b", 2), ("bcd", 3), ("가나다", 4), ("\U0001f600x", 5), ("zz", 6)], "word string, n int")
    titles = ["abcd", "b", "가나다 ab", "\U0001f600x", "", None, "x가나", "\U0001f600\U0001f600xb"]
    df = D.with_contained(spark.createDataFrame(list(enumerate(titles)), "i long, t string"), "i", "t", words, "found")
    want = {i: sorted(n for w, n in words.rows if t and w in t) for i, t in enumerate(titles)}
    assert {r.i: sorted(e.n for e in r.found) for r in df.collect()} == want
    assert "sequence(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_batches_log_what_they_wrote(spark):
    from tests.test_golden_titles import lexicon

    base = folder(spark, "logged")
    schema = "report_id long, firm_nm string, article_title string, tags array<string>"
    words = Z.sector_dictionary(spark.createDataFrame([("은행", "은행")], "word string, sector string"))
    real = lambda df: N.enrich_titles(df, lexicon(spark), words)
    for k in range(3):
        rows = [(10 * k + i, "F", "삼성전자 (005930): 목표가 110,000원 상향" if i < k else "nothing", None) for i in range(4)] + [(10 * k + 9, "F", "done", ["x"])]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        J.stream_enrich(J.file_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema), real, f"{base}/out", f"{base}/ck", None, log=f"{base}/log").awaitTermination()
    log = J.batch_log(spark, f"{base}/log").orderBy("batch").collect()
    assert [tuple(r)[:5] for r in log] == [(k, 4, k, 4 - k, 0) for k in range(3)] and all(r.micros > 0 for r in log)
    assert V.throughput_log(J.batch_log(spark, f"{base}/log")).agg(F.max("rows_upto")).first()[0] == spark.read.parquet(f"{base}/out").count() == 12


def test_outcomes_come_with_the_write(spark):
    df = _plain(spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "report_id long, article_title string"))
    more = [F.array(F.lit("x")).alias("tags"), F.array().cast("array<string>").alias("stock_names"), F.lit("").alias("sector")]
    df = df.withColumn("enriched", F.struct("enriched.status", *more))
    seen = Observation()
    U.observed_outcomes(df, seen).write.format("noop").mode("overwrite").save()
    assert tuple(seen.get[c] for c in U.OUTCOMES) == tuple(U.batch_outcomes(df).first()) == (3, 2, 0, 1)


# ---- stored tables -------------------------------------------------------------------


def _table(spark, rows):
    return spark.createDataFrame(rows, "report_id long, sector string, reg_month string")


def test_readers_see_a_publication_whole_or_not_at_all(spark, monkeypatch):
    store = Snapshots(spark, folder(spark, "store"), {"t": "reg_month", "u": "reg_month"})
    with pytest.raises(LookupError):
        store.read("t")
    first = [(1, "a", "202601"), (2, "b", "202602"), (3, "c", None)]
    assert store.publish({"t": (_table(spark, first), ["202601", "202602", None]), "u": (_table(spark, []), [])}) == 1
    seen = lambda version=None: sorted(tuple(r) for r in store.read("t", version).collect())
    key = lambda rows: sorted(rows, key=lambda r: r[0])
    assert seen() == key(first) and store.read("u").collect() == []
    change = {"t": (_table(spark, [(1, "A", "202601"), (3, "C", None)]), ["202601", None]), "u": (_table(spark, [(9, "z", "202601")]), ["202601"])}
    # broken off after the data is written and before the manifest is
    broken = monkeypatch.context()
    with broken as m:
        m.setattr("reportloom.sources.snapshots.MANIFEST", "version bigint, table string")
        with pytest.raises(Exception):
            store.publish(change)
    assert store.version() == 1 and seen() == key(first) and store.read("u").collect() == []
    assert store.publish(change) == 2
    assert seen() == [(1, "A", "202601"), (2, "b", "202602"), (3, "C", None)] and store.read("u").count() == 1
    assert seen(1) == key(first)
    # a part without rows is empty from then on, others stay
    assert store.publish({"t": (_table(spark, []), ["202602"])}) == 3
    assert [r[0] for r in seen()] == [1, 3] and store.read("u").count() == 1
    # only the folders of the asked month are opened: whoever opens another one fails
    for path in glob.glob(f"{store.path}/t/*/reg_month=*/*.parquet"):
        if "202601" not in path:
            tear(path)
    assert [tuple(r) for r in store.read("t").where("reg_month = '202601'").collect()] == [(1, "A", "202601")]
    with pytest.raises(Exception):
        store.read("t").collect()


def test_a_cycle_that_breaks_off_changes_nothing(spark, monkeypatch):
    from tests.test_golden_titles import lexicon

    rows = [(1, "F", "삼성전자 (005930): 목표가 110,000원 상향", "202601", None), (2, "F", "nothing to find", "202601", None), (3, "F", "삼성전자", "202602", ["done"]), (4, "F", "은행 산업 동향", None, None)]
    table = spark.createDataFrame(rows, "report_id long, firm_nm string, article_title string, reg_month string, tags array<string>")
    table = U.add_premium_columns(table.withColumns({"stock_names": F.lit(None).cast("array<string>"), "sector": F.lit(None).cast("string")}))
    words = Z.sector_dictionary(spark.createDataFrame([("은행", "은행")], "word string, sector string"))
    real = lambda df: N.enrich_titles(df, lexicon(spark), words)
    store = open_store(spark, folder(spark, "cycle"))
    fill_store(store, table)
    before = V.coverage_of_months(store.read("coverage")).first()
    assert tuple(before) == tuple(V.coverage_summary(table).first())
    with monkeypatch.context() as m:
        m.setattr(Snapshots, "publish", lambda *a: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            publish_cycle(store, real, "v1")
    assert store.version() == 1 and store.read("ledger").count() == 0
    assert publish_cycle(store, real, "v1") == {"total": 3, "enriched": 2, "skipped": 1, "errors": 0}
    assert publish_cycle(store, real, "v1")["total"] == 0 and store.version() == 2
    got = {r.report_id: r for r in store.read("reports").collect()}
    assert len(got) == 4 and got[1].target_price == 110000 and got[3].tags == ["done"] and got[4].sector == "은행"
    # counts of touched months, taken anew, agree with a count of everything
    assert tuple(V.coverage_of_months(store.read("coverage")).first()) == tuple(V.coverage_summary(store.read("reports")).first())
    recount = V.tag_topk_delta(store.read("reports", 1).select("tags"), store.read("reports").select("tags"))
    kept = V.tag_topk_of_months(store.read("tag_counts", 1), store.read("tag_counts"))
    assert [tuple(r) for r in kept.collect()] == [tuple(r) for r in recount.collect()]
    # a second cycle with new rules
    assert publish_cycle(store, real, "v2")["total"] == 1 and store.version() == 3
    assert tuple(V.coverage_of_months(store.read("coverage")).first()) == tuple(V.coverage_summary(store.read("reports")).first())


def test_only_a_missing_path_is_an_empty_table(spark):
    path = folder(spark, "ledger")
    assert read_ledger(spark, path).count() == 0
    spark.createDataFrame([("torn",)], "value string").write.text(path)
    with pytest.raises(AnalysisException):
        read_if_there(spark, path, "a int, a int")
    with pytest.raises(Exception):
        read_ledger(spark, path).collect()


def test_a_lookup_opens_few_files(spark):
    path = folder(spark, "clustered")
    rows = spark.range(0, 20_000, 2).select(F.col("id").alias("report_id"), (F.col("id") % 7).alias("x"))
    K.write_clustered(rows.unionByName(spark.createDataFrame([(None, 1)], "report_id long, x long")).repartition(8), path, "report_id", 16)
    ids = spark.createDataFrame([(i,) for i in [*range(4000, 4600), 4000, 19_998, 50_001, None]], "report_id long")
    files = K.files_with(spark, path, ids, "report_id")
    assert 2 <= len(files) <= 4 and len(glob.glob(f"{path}/rows/*.parquet")) >= 12
    got = sorted(tuple(r) for r in K.read_by_keys(spark, path, ids, "report_id").collect())
    assert got == [(i, i % 7) for i in [*range(4000, 4600, 2), 19_998]]
    assert K.read_by_keys(spark, path, ids.limit(0), "report_id").collect() == []


def test_gates_cut_only_when_asked(spark):
    from reportloom.operators import pages as H

    df = spark.createDataFrame([("x" * 12_000,), ("short",), (None,)], "t string")
    whole = [r[0] for r in df.select(H.text_gates(F.col("t"), 200)).collect()]
    cut = [r[0] for r in df.select(H.text_gates(F.col("t"), 200, H.MOST)).collect()]
    assert whole == ["x" * 12_000, None, None] and cut == ["x" * 10_000, None, None]

"""Keyed updates, dimensions, pages, answers, numbering and streams on small tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from reportloom.functions.numbering import with_row_number, with_running_sums
from reportloom.functions.text import strip
from reportloom.operators import answers as A
from reportloom.operators import candidates as C
from reportloom.operators import dimensions as G
from reportloom.operators import enrich as N
from reportloom.operators import matching as M
from reportloom.operators import merging as U
from reportloom.operators import pages as H
from reportloom.operators import sectors as Z
from reportloom.operators import structured as P
from reportloom.session import shared_dir
from reportloom.sources import tables as S
from reportloom.streaming import jobs as J


def test_dimension_flow(spark):
    title = "팸텍 (271830.KQ): IPO 주관사 업데이트: 반도체 주도 성장"
    reports = spark.createDataFrame([(1, "하나증권", title, "홍길동 연구원, 김철수 선임")], "report_id long, firm_nm string, article_title string, writer string")
    firms = spark.createDataFrame([("하나증권", 11)], "firm_nm string, sec_firm_order int")
    analysts = G.upsert_analysts(reports, firms, spark.createDataFrame([], S.ANALYSTS))
    again = G.upsert_analysts(reports, firms, analysts)
    assert again.count() == 2
    bridge = G.report_analyst_bridge(reports, firms, analysts, spark.createDataFrame([], S.REPORT_ANALYSTS))
    assert G.report_analyst_bridge(reports, firms, analysts, bridge).count() == 2
    assert M.report_analysts_read(bridge, analysts, reports).first()["names"] == ["김철수", "홍길동"]
    new = spark.createDataFrame([(1, 2026, 50, 8, None), (1, 2026, 60, 9, None)], "report_id long, year int, sales int, operating_profit int, net_income int")
    new = new.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("sales", "operating_profit", "net_income")})
    stored = G.upsert_forecasts(spark.createDataFrame([], S.FORECASTS), new, [])
    row = M.report_forecasts_read(stored, reports).collect()
    assert [(r.year, int(r.sales), int(r.operating_profit)) for r in row] == [(2026, 50, 8)]
    premium = U.add_premium_columns(reports)
    assert premium.columns[-5:] == ["target_price", "rating", "revision_type", "report_type", "stock_tickers"]
    assert premium.select(P.direct_tickers(F.lit("삼성전자 (005930)"))).first()[0] == ["005930"]


def test_updates_touch_only_their_rows(spark):
    base = spark.createDataFrame([(1, ["a"], None, "x"), (2, None, ["n"], "y")], "report_id long, tags array<string>, stock_names array<string>, sector string")
    new = spark.createDataFrame([(2, ["b"], None, "")], base.schema)
    out = {r.report_id: tuple(r)[1:] for r in U.schema_adaptive_write(base, new).collect()}
    assert out == {1: (["a"], None, "x"), 2: (["b"], None, "")}
    assert U.json_columns(base).orderBy("report_id").first()["tags"] == '["a"]'


def test_ledger_ends_starvation(spark):
    reports = spark.createDataFrame([(i, "F", "misc", None) for i in range(5)], "report_id long, firm_nm string, article_title string, tags array<string>")
    ledger = U.processed_ledger(C.pending_reports(reports, 2), "v1")
    left = C.pending_reports(reports, 10, ledger, "v1")
    assert sorted(r.report_id for r in left.collect()) == [0, 1, 2]
    assert C.pending_reports(reports, 10, ledger, "v2").count() == 5


PAGES = [
    ('<x id="bo_v_con">' + "a<b>b</b>&nbsp; c" * 8 + "</div>\n</section>", True),
    ('<x id="bo_v_con">' + "y" * 30 + "</div>", False),
    ('<x id="bo_v_con">' + "y" * 31 + "</div>", True),
    ("<p>no container</p>", False),
]


def test_container_text(spark):
    df = spark.createDataFrame([(h,) for h, _ in PAGES], "html string")
    got = [r[0] for r in df.select(H.container_text(F.col("html"))).collect()]
    assert [g is not None for g in got] == [want for _, want in PAGES]
    assert "<" not in got[0] and "  " not in got[0]


def test_block_text(spark):
    html = "<div>short</div><div class='x'>" + "w " * 150 + "</div><div>" + "z" * 300 + "</div>"
    df = spark.createDataFrame([(html,), ("<div>none</div>",)], "html string")
    assert [r[0] for r in df.select(H.first_long_block(F.col("html"))).collect()] == [("w " * 150).strip(), None]


def test_quarantine(spark):
    df = spark.createDataFrame([(1, bytearray("글".encode())), (2, bytearray(b"\xea\xb8")), (3, None)], "report_id long, html_bytes binary")
    got = {r.report_id: (r.html, r.quarantined) for r in H.utf8_quarantine(df).collect()}
    assert got == {1: ("글", False), 2: (None, True), 3: (None, False)}


def test_answers(spark):
    texts = [
        '```json\n[{"id":1,"tags":"x"},{"id":0,"tags":["no"]},{"tags":["no"]}]\n[{"id":2,"tags":null,"sector":"s"}]\n```',
        '{"results":[{"id":3,"tags":["a","b"],"stock_names":"n"}]}',
        "no json at all",
        '[{"id":3,"tags":["last"]}][{"id":4,"tags":7}]',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "answer_no long, answer string")
    got = {r.report_id: (r.tags, r.sector, r.stock_names) for r in A.latest_answer_per_id(A.parse_answers(df)).collect()}
    assert got == {1: (["x"], "", []), 2: ([], "s", []), 3: (["last"], "", []), 4: (["7"], "", [])}


def test_prompts(spark):
    rows = [(i, f"t{i}", None if i % 3 else i // 6) for i in range(25)]
    prompts = A.prompt_batches(spark.createDataFrame(rows, "report_id long, article_title string, linked_summary_id long"))
    order = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), -r[0]))
    got = [i for r in prompts.orderBy("batch").collect() for i in r.ids]
    assert got == [r[0] for r in order] and prompts.count() == 3


def test_numbering_is_global(spark):
    df = spark.range(1000).withColumn("v", F.pmod(F.hash("id"), F.lit(17)))
    numbered = with_row_number(df, [F.desc("v"), F.col("id")]).collect()
    want = {r: i + 1 for i, r in enumerate(sorted(((x.v, x.id) for x in numbered), key=lambda p: (-p[0], p[1])))}
    assert all(want[(r.v, r.id)] == r.rn for r in numbered)
    run = with_running_sums(df, [F.col("id")], {"s": "v"}).orderBy("id").collect()
    total = 0
    for r in run:
        total += r.v
        assert r.s == total


def test_url_propagation(spark):
    s = spark.createDataFrame([(1, ""), (2, None), (3, "kept"), (4, None)], "summary_id long, pdf_url string")
    r = spark.createDataFrame([(10, 1, "old"), (11, 1, "new"), (12, 3, "other"), (13, 4, "late"), (14, 2, "")], "report_id long, linked_summary_id long, telegram_url string")
    get = lambda n: {x.summary_id: x.pdf_url for x in M.propagate_pdf_url(s, r, n).collect()}
    assert get(None) == {1: "new", 2: None, 3: "kept", 4: "late"}
    assert get(1) == {1: "new", 2: None, 3: "kept", 4: None}
    # summary 2 cannot be filled and does not stand in the way of 4
    assert get(2) == get(None)


def test_merge_takes_one_row_per_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "report_id long, sector string")
    new = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (9, "w")], "report_id long, sector string")
    assert sorted(tuple(r) for r in U.apply_updates(base, new, ["sector"]).collect()) == [(1, "y"), (2, "b")]


def test_links_stay_and_json_report_reads_back(spark):
    reports = spark.createDataFrame([(1, None), (2, 7), (3, None)], "report_id long, linked_summary_id long")
    found = spark.createDataFrame([(1, 5), (2, 6)], "report_id long, summary_id long")
    linked = M.link_reports(reports, found)
    assert {r.report_id: r.linked_summary_id for r in linked.collect()} == {1: 5, 2: 7, 3: None}
    path = f"{shared_dir(spark)}/json-{uuid.uuid4().hex}"
    S.write_json_report(linked.withColumn("tags", F.array(F.lit("매수 의견"), F.lit('a"b'))), path)
    back = S.read_files(spark, path, "json", "report_id long, linked_summary_id long, tags array<string>").orderBy("report_id").collect()
    assert [tuple(r) for r in back] == [(i, s, ["매수 의견", 'a"b']) for i, s in ((1, 5), (2, 7), (3, None))]


def test_name_and_word_tables_from_files(spark):
    base = f"{shared_dir(spark)}/names-{uuid.uuid4().hex}"
    rows = [(1, "AA", "000001", "S", True), (2, "AA", "000002", "T", True), (3, "BB", None, None, True), (4, "CC", "000003", None, False), (5, None, "x", None, True)]
    spark.createDataFrame(rows, "rank int, word string, code string, sector string, searched boolean").write.option("header", "true").csv(f"{base}/names")
    got = {r.word: (r.rank, r.code, r.sector, r.ticker_rank) for r in S.read_lexicon(spark, f"{base}/names").collect()}
    assert got == {"AA": (1, "000001", "S", 1), "BB": (3, None, None, None), "CC": (None, "000003", None, 4)}
    spark.createDataFrame([("w", "A"), ("w", "B")], "word string, sector string").write.option("header", "true").csv(f"{base}/words")
    assert [tuple(r) for r in S.read_sector_words(spark, f"{base}/words").collect()] == [("w", "B")]


def test_answer_tags_by_kind(spark):
    cases = {'["a","b"]': ["a", "b"], '"0"': ["0"], '"false"': ["false"], '""': [], "0": [], "7": ["7"], "true": ["True"], "false": [], "null": [], "{}": [], '{"k":1}': ['{"k":1}']}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, j string").withColumn("v", F.parse_json("j"))
    got = df.select("i", A.coerce_tags(F.col("v")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == list(cases.values())


def test_texts_are_whole_unless_asked(spark):
    page = '<section id="bo_v_con">' + "x y " * 5000 + "</div></section>"
    df = spark.createDataFrame([(page,)], "html string")
    assert len(df.select(H.container_text(F.col("html"))).first()[0]) == 19_999
    assert len(df.select(H.container_text(F.col("html"), most=H.MOST)).first()[0]) == 10_000


def test_six_names_are_kept_whole(spark):
    from tests.test_golden_titles import enriched

    got = enriched(spark, ["삼성전자 SK하이닉스 현대차 카카오 네이버 기아 고려아연 비교"])[0]
    assert len(got["stock_names"]) == 5 and len(got["all_names"]) > 5 and got["all_names"][:5] == got["stock_names"]


@pytest.mark.parametrize("inline_rows", [4096, 0])
def test_streams_enrich_with_any_dictionary(spark, inline_rows):
    from tests.test_golden_titles import lexicon

    base = f"{shared_dir(spark)}/real-{uuid.uuid4().hex}"
    rows = [(1, "K1", "F", "삼성전자 (005930): 목표가 110,000원 상향", None), (2, "K2", "F", "은행 산업 동향", None), (3, "K3", "F", None, None)]
    spark.createDataFrame(rows, "report_id long, key string, firm_nm string, article_title string, tags array<string>").write.parquet(f"{base}/in")
    words = Z.sector_dictionary(spark.createDataFrame([("은행", "은행")], "word string, sector string"), inline_rows)
    real = lambda df: N.enrich_titles(df, lexicon(spark, inline_rows), words)
    stored = spark.read.parquet(f"{base}/in")
    for name, start in {
        "all": lambda s, *a: J.stream_enrich(s, real, *a),
        "keys": lambda s, *a: J.stream_on_arrival(s.select("key"), stored, real, *a),
        "split": lambda s, *a: J.stream_isolation(s, real, *a),
    }.items():
        start(J.file_stream(spark, f"{base}/in", stored.schema), f"{base}/{name}", f"{base}/{name}-ck", None).awaitTermination()
        got = {r.report_id: r.enriched for r in spark.read.parquet(f"{base}/{name}").collect()}
        assert got[1].stock_names[0] == "삼성전자" and got[1].target_price == 110000 and got[2].sector == "은행"
        assert sorted(got) == ([1, 2, 3] if name == "split" else [1, 2])


def test_a_summary_that_comes_later_is_matched(spark):
    base = f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"
    reports = spark.createDataFrame(
        [(1, "F", "Alpha raises", "", "20260105", None), (2, "F", "Beta", "", "20260105", None)],
        "report_id long, firm_nm string, article_title string, writer string, reg_dt string, linked_summary_id long",
    )
    schema = "summary_id long, provider string, report_date string, company_name string, author string"
    first = spark.createDataFrame([(8, "F", "2026.01.05", "Beta", "")], schema)
    first.coalesce(1).write.parquet(f"{base}/in")
    assert [r.report_id for r in M.match_summaries(reports, first).collect()] == [2]
    run = lambda: J.stream_match_late(J.file_stream(spark, f"{base}/in", first.schema, files_per_trigger=1), reports, f"{base}/out", f"{base}/ck", None).awaitTermination()
    run()
    spark.createDataFrame([(9, "F", "2026.01.07", "Alpha", "")], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    run()
    found = spark.read.parquet(f"{base}/out").select("report_id", "summary_id")
    assert sorted(tuple(r) for r in found.collect()) == [(1, 9), (2, 8)]
    linked = M.link_reports(reports, found)
    assert {r.report_id: r.linked_summary_id for r in linked.collect()} == {1: 9, 2: 8}


def test_strip_every_space(spark):
    df = spark.createDataFrame([("　\t a b \n",)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == "a b"


def test_month_partitions_are_replaced_alone(spark):
    path = f"{shared_dir(spark)}/months-{uuid.uuid4().hex}"
    S.write_by_month(spark.createDataFrame([(1, "20260105"), (2, "20260210")], "report_id long, reg_dt string"), path)
    S.write_by_month(spark.createDataFrame([(3, "20260211")], "report_id long, reg_dt string"), path)
    assert sorted(r.report_id for r in S.read_files(spark, path).collect()) == [1, 3]


def test_stream_goes_on_where_it_stopped(spark):
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = "report_id long, firm_nm string, article_title string, tags array<string>"
    enrich = lambda df: df.withColumn("enriched", F.struct(F.upper("article_title").alias("t"), F.when(F.col("article_title") != "bad", "success").otherwise("error").alias("status")))

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")

    def run(job, name):
        stream = J.file_stream(spark, f"{base}/in", spark.createDataFrame([], schema).schema, files_per_trigger=1)
        job(stream, enrich, f"{base}/{name}", f"{base}/{name}-ck", every=None).awaitTermination()
        return sorted((r.report_id, r.enriched.status) for r in spark.read.parquet(f"{base}/{name}").collect())

    arrive([(1, "F", "a", None), (2, "F", "", None), (3, "F", "c", ["done"])])
    assert run(J.stream_enrich, "out") == [(1, "success")]
    arrive([(4, "F", "bad", [])])
    assert run(J.stream_enrich, "out") == [(1, "success"), (4, "error")]
    run(J.stream_isolation, "split")
    routes = {r.report_id: r.route for r in spark.read.parquet(f"{base}/split").collect()}
    assert routes == {1: "good", 2: "good", 3: "good", 4: "quarantine"}


@pytest.mark.parametrize("name", ["match_tiebreak", "prompt_batches", "latest_answer_per_id", "throughput_log", "badge_tags", "enrich_titles", "stream_match"])
def test_query_equals_its_sql(spark, sf_dir, name):
    from tests.compare import compare

    assert compare(spark, sf_dir, name) is None


def test_cycle_replaces_touched_months_alone(spark):
    import os

    from reportloom.operators.cycle import run_cycle
    from tests.test_golden_titles import lexicon

    base = f"{shared_dir(spark)}/cycle-{uuid.uuid4().hex}".removeprefix("file:")
    rows = [(1, "F", "삼성전자 (005930): 목표가 110,000원 상향", "20260105", None), (2, "F", "nothing to find", "20260106", None), (3, "F", "삼성전자", "20260210", ["done"])]
    table = spark.createDataFrame(rows, "report_id long, firm_nm string, article_title string, reg_dt string, tags array<string>")
    wide = table.withColumns({"stock_names": F.lit(None).cast("array<string>"), "sector": F.lit(None).cast("string")})
    S.write_by_month(U.add_premium_columns(wide), f"{base}/reports")
    files = lambda: sorted(f"{d}/{f}" for d, _, names in os.walk(f"{base}/reports/reg_month=202602") for f in names)
    before = files()
    words = Z.sector_dictionary(spark.createDataFrame([("은행", "은행")], "word string, sector string"))
    run = lambda version: run_cycle(spark, f"{base}/reports", f"{base}/ledger", lambda df: N.enrich_titles(df, lexicon(spark), words), version)
    assert run("v1") == 2 and run("v1") == 0
    assert before and files() == before
    got = {r.report_id: (r.tags, r.target_price) for r in spark.read.parquet(f"{base}/reports").collect()}
    assert got[1][1] == 110000 and got[1][0] and got[3][0] == ["done"] and len(got) == 3
    # new rules look again at what stayed empty
    assert run("v2") == 1


@pytest.mark.parametrize("dates", [(None, "", "20260105"), (None, "", None)])
def test_cycle_stores_reports_without_date(spark, dates):
    from reportloom.operators.cycle import run_cycle
    from tests.test_golden_titles import lexicon

    base = f"{shared_dir(spark)}/cycle-{uuid.uuid4().hex}".removeprefix("file:")
    rows = [(i, "F", "삼성전자 (005930): 목표가 110,000원 상향", d, None) for i, d in enumerate(dates)] + [(9, "F", "삼성전자", "20260210", ["done"])]
    table = spark.createDataFrame(rows, "report_id long, firm_nm string, article_title string, reg_dt string, tags array<string>")
    wide = table.withColumns({"stock_names": F.lit(None).cast("array<string>"), "sector": F.lit(None).cast("string")})
    S.write_by_month(U.add_premium_columns(wide), f"{base}/reports")
    words = Z.sector_dictionary(spark.createDataFrame([("은행", "은행")], "word string, sector string"))
    run = lambda: run_cycle(spark, f"{base}/reports", f"{base}/ledger", lambda df: N.enrich_titles(df, lexicon(spark), words), "v1")
    assert run() == 3
    got = {r.report_id: (r.tags, r.target_price) for r in spark.read.parquet(f"{base}/reports").collect()}
    assert len(got) == 4 and got[9][0] == ["done"]
    assert all(got[i][0] and got[i][1] == 110000 for i in range(3))
    assert run() == 0

"""Known titles and what must come out of them."""

import pytest
from pyspark.sql import functions as F

from reportloom.functions import dictionaries as D
from reportloom.operators import enrich as N
from reportloom.operators import entities as E
from reportloom.operators import sectors as S
from reportloom.operators import structured as P

NAMES = [
    ("삼성전자", "005930", "반도체"),
    ("SK하이닉스", "000660", "반도체"),
    ("SK", "034730", None),
    ("현대차", "005380", "자동차"),
    ("카카오", "035720", "인터넷/플랫폼"),
    ("네이버", "035420", None),
    ("기아", "000270", "자동차"),
    ("고려아연", "010130", "철강/비철"),
    ("Samsung", "005930", None),
    ("JYP Ent.", "035900", "엔터테인먼트"),
    ("POSCO", "005490", None),
    ("금호석유", "011780", None),
    ("한미반도체", None, "반도체"),
]

WORDS = [("반도체", "반도체"), ("2차전지", "2차전지"), ("자동차", "자동차"), ("ai", "IT/SW"), ("은행", "은행"), ("조선", "조선")]


def lexicon(spark, inline_rows=D.INLINE_ROWS):
    rows = [(i if c else None, n, c, s, i if c else None) for i, (n, c, s) in enumerate(NAMES)]
    known = spark.createDataFrame(rows, E.LEXICON_SCHEMA)
    return E.lexicon(known, inline_rows)


def enriched(spark, titles, compat=False, inline_rows=D.INLINE_ROWS):
    df = spark.createDataFrame(list(enumerate(titles)), "report_id long, article_title string")
    words = S.sector_dictionary(spark.createDataFrame(WORDS, "word string, sector string"), inline_rows)
    out = N.enrich_titles(df, lexicon(spark, inline_rows), words, compat=compat)
    return [r.enriched.asDict() for r in out.orderBy("report_id").collect()]


TITLES = {
    "삼성전자 (005930): 목표가 110,000원 상향, 투자의견 매수": dict(
        stock_names=["삼성전자", "Samsung"], sector="반도체", tags=["목표주가 상향", "매수 의견", "기업 분석"],
        target_price=110000, revision_type="UPGRADE", rating="BUY", report_type="COMPANY", stock_tickers=["005930"],
    ),
    "네이버: 목표주가 24만 원으로 하향, HOLD의견 제시": dict(target_price=240000, revision_type="DOWNGRADE", rating="HOLD"),
    "기아 (000270): 목표가 150,000원 유지": dict(target_price=150000, revision_type="MAINTAIN"),
    "[New K-ETF] 현대차 로보틱스 밸류체인 TOP3+": dict(stock_tickers=["005380"]),
    "삼성전자와 SK하이닉스 반도체 전면 비교 분석": dict(stock_tickers=["000660", "005930"], stock_names=["SK하이닉스"]),
    "SK하이닉스 실적 최고치 경신 전망": dict(stock_tickers=["000660"]),
    "SK하이닉스, SK 비교": dict(stock_tickers=["000660", "034730"]),
    "팸텍 (271830.KQ): IPO 주관사 업데이트: 반도체 주도 성장": dict(
        target_price=None, rating="BUY", stock_names=["팸텍"], sector="반도체"
    ),
    "2차전지 배터리 양극재 산업 동향 점검": dict(report_type="INDUSTRY", stock_names=[]),
    "연준 FOMC 금리 동결 결정과 환율 전망": dict(report_type="MACRO"),
    "2026년 하반기 모델 포트폴리오 자산배분 전략 수립": dict(report_type="STRATEGY"),
    "퀀트 스크리닝을 통한 계량분석 실전 매매": dict(report_type="QUANT"),
    "   ": dict(tags=[], stock_names=[], sector="", status="success", note="no title", target_price=None),
    "한미반도체(042700) 탐방": dict(stock_names=["한미반도체"], sector="반도체"),
    "유안타 주간 추천종목 하이브 (352820)": dict(stock_names=["하이브"]),
}
HOLDS = {
    "삼성전자 목표가 유지 의견 제시": ["목표주가 유지"],
    "카카오 투자의견 유지와 밸류에이션 분석": ["투자의견 유지"],
    "두산에너빌리티 5000억 블록딜 단행과 전환사채 및 신주인수권부사채 발행": ["블록딜", "메자닌"],
    "고려아연 경영권 분쟁 소식에 상한가 기록": ["경영권 분쟁"],
    "SK하이닉스(000660): 반도체 업황 개선 및 반도체 신기술 발표": ["반도체 신기술"],
}


@pytest.mark.parametrize("inline_rows", [D.INLINE_ROWS, 0], ids=["inline", "joined"])
def test_fields(spark, inline_rows):
    for (title, want), got in zip(TITLES.items(), enriched(spark, list(TITLES), inline_rows=inline_rows)):
        assert {k: got[k] for k in want} == want, title


@pytest.mark.parametrize("inline_rows", [D.INLINE_ROWS, 0], ids=["inline", "joined"])
def test_tags(spark, inline_rows):
    for (title, want), got in zip(HOLDS.items(), enriched(spark, list(HOLDS), inline_rows=inline_rows)):
        assert set(want) <= set(got["tags"]), title
        assert "SK하이닉스" not in got["tags"] and "반도체" not in got["tags"]


def test_null_title_is_an_error(spark):
    got = enriched(spark, ["x", None])[1]
    assert got["status"] == "error" and got["tags"] == []


def test_compat_keeps_the_oddities(spark):
    titles = ["목표가 90000원 하향", "Daily note", "JYP Ent. 신보"]
    fixed, old = enriched(spark, titles), enriched(spark, titles, compat=True)
    assert (fixed[0]["target_price"], fixed[0]["revision_type"]) == (90000, "DOWNGRADE")
    assert (old[0]["target_price"], old[0]["revision_type"]) == (None, "MAINTAIN")
    assert (fixed[1]["sector"], old[1]["sector"]) == ("", "IT/SW")
    assert (fixed[2]["stock_names"], old[2]["stock_names"]) == (["JYP Ent."], [])


def test_stop_names_win_over_the_name_table(spark):
    assert enriched(spark, ["POSCO 철강 업황"])[0]["stock_names"] == []


def test_keyword_tie_takes_the_greater_sector(spark):
    df = spark.createDataFrame([(1, "aaaa bbbb")], "report_id long, t string")
    words = spark.createDataFrame([("aaaa", "S1"), ("bbbb", "S2"), ("aa", "S9")], "word string, sector string")
    hits = D.with_contained(df, "report_id", "t", S.sector_dictionary(words), "w")
    assert hits.select(S.keyword_sector(F.col("t"), F.col("w"))).first()[0] == "S2"


@pytest.mark.parametrize(
    "writer, names",
    [
        ("홍길동 연구원, 김철수 책임연구원, Analyst 임꺽정", ["홍길동", "김철수", "임꺽정"]),
        ("성춘향 선임 / 이몽룡 위원", ["성춘향", "이몽룡"]),
        ("", []),
        (None, []),
    ],
)
def test_split_analysts(spark, writer, names):
    df = spark.createDataFrame([(writer,)], "w string")
    assert df.select(P.split_analysts(F.col("w"))).first()[0] == names


def test_lists_are_bounded_and_clean(spark, sf_dir):
    from reportloom.plans.catalog import Tables

    for r in Tables(spark, sf_dir).enriched().select("enriched.*").collect():
        assert len(r.tags) <= 8 and len(r.stock_names) <= 5
        assert r.sector not in r.tags
        assert set(r.tags) & set(r.stock_names) <= {"기업 분석"}


def test_partitioning_does_not_matter(spark, sf_dir):
    from reportloom.plans.catalog import Tables

    t = Tables(spark, sf_dir)
    titles = t.reports.select("report_id", "article_title")
    rows = lambda df: sorted((r.report_id, str(r.enriched)) for r in t.enriched(df).select("report_id", "enriched").collect())
    assert rows(titles.coalesce(1)) == rows(titles.repartition(7))

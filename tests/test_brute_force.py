"""Random small inputs against plain Python written from the definitions."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportloom import rules
from reportloom.functions import dictionaries as D
from reportloom.operators import dimensions as G
from reportloom.operators import entities as E
from reportloom.operators import matching as M
from reportloom.operators import structured as P
from reportloom.operators import tags as T

ALL_RULES = rules.tag_rules() + rules.action_rules()


@pytest.mark.parametrize("rule", ALL_RULES, ids=lambda r: f"{r.rank}-{r.label}")
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_every_match_contains_a_literal(rule, data):
    """The literals tested before a regex never hide a match."""
    text = data.draw(st.from_regex(re.compile(rule.pattern, re.I | re.A)))
    folded = text.lower()
    assert any(w in folded for w in rule.words) or any(lit in folded for lit, _ in rule.gated)


def test_rules_equal_plain_regex_search(spark):
    rng = random.Random(5)
    parts = [w for r in ALL_RULES for w in re.findall(r"[가-힣A-Za-z]{2,}", r.pattern)]
    titles = [" ".join(rng.choice(parts) for _ in range(4)).replace(" ", rng.choice(["", " ", " "])) for _ in range(300)]
    titles += ["1Q24 FY25 실적", "EV3 and ev", "(ABC.US) foo", "On-Chain", "AI", "삼성AI전략", "2Q24실적", "ＥＶ", "ſmall cap", "목표가\n상향"]
    df = T.with_rule_text(spark.createDataFrame(list(enumerate(titles)), "i long, t string"), "t")
    got = {r.i: (r.tags, r.action) for r in df.select("i", T.matching_labels("t").alias("tags"), T.first_label("t").alias("action")).collect()}
    for i, title in enumerate(titles):
        want = list(dict.fromkeys(r.label for r in rules.tag_rules() if re.search(r.pattern, title, re.I)))
        first = next((r.label for r in rules.action_rules() if re.search(r.pattern, title, re.I)), None)
        assert got[i] == (want, first), title


def claim(title, lexicon):
    taken, codes = [], set()
    for _, name, code in sorted(lexicon, key=lambda e: (-len(e[1]), e[0])):
        for m in re.finditer(re.escape(name), title):
            if not any(m.start() < b and m.end() > a for a, b in taken):
                taken.append(m.span())
                codes.add(code)
                break
    return sorted(codes)


@pytest.mark.parametrize("inline_rows", [D.INLINE_ROWS, 0], ids=["inline", "joined"])
def test_span_claims(spark, inline_rows):
    rng = random.Random(7)
    names = sorted({"".join(rng.choice("ab ") for _ in range(rng.randint(1, 5))).strip() or "a" for _ in range(25)})
    lexicon = [(i, n, f"{i:06d}") for i, n in enumerate(names)]
    titles = ["".join(rng.choice("ab .") for _ in range(rng.randint(1, 14))) for _ in range(300)]
    table = spark.createDataFrame([(i, n, c, None, i) for i, n, c in lexicon], E.LEXICON_SCHEMA)
    df = spark.createDataFrame(list(enumerate(titles)), "report_id long, t string")
    df = E.with_candidates(df, "t", E.lexicon(table, inline_rows), "lex", "report_id")
    got = df.select("report_id", F.array_sort(F.array_distinct(P.claimed_tickers(F.col("t"), F.col("lex")))).alias("c"))
    got = {r.report_id: r.c for r in got.collect()}
    for i, title in enumerate(titles):
        assert got[i] == claim(title, lexicon), title


@pytest.mark.parametrize("size", [0, 4], ids=["joined", "inline"])
def test_contained_words(spark, size):
    rng = random.Random(3)
    words = [("a",), ("ab",), ("abca",), ("가나다",)]
    texts = ["".join(rng.choice("abc가나다") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    found = D.with_contained(df, "k", "t", D.load(spark.createDataFrame(words, "word string"), size), "w")
    for r in found.collect():
        assert sorted(e.word for e in r.w) == sorted(w for (w,) in words if w in r.t)


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("inline_rows", [D.INLINE_ROWS, 0], ids=["inline", "joined"])
def test_match_against_all_pairs(spark, compat, inline_rows):
    """Half of all rows share one firm, one company and one day."""
    from datetime import date, timedelta

    rng = random.Random(11)
    day = lambda: date(2026, 5, 31) if rng.random() < 0.5 else date(2026, 5, 25) + timedelta(days=rng.randint(0, 14))
    firm = lambda: "F0" if rng.random() < 0.5 else f"F{rng.randint(1, 3)}"
    company = lambda: "alpha" if rng.random() < 0.5 else rng.choice(["beta", "alp", "gam ma"])
    reports = [
        (i, firm(), day(), rng.choice(["", None, "Kim", "Kim, Lee", "K"]), f"{company()} and {company()}", rng.choice([None, None, 5]))
        for i in range(150)
    ]
    summaries = [(i, firm(), day(), company(), rng.choice(["Kim.Lee", "Kim", "Lee", "", "Kimura"])) for i in range(120)]
    rdf = spark.createDataFrame(
        [(i, f, f"{d:%Y%m%d}", w, t, s) for i, f, d, w, t, s in reports],
        "report_id long, firm_nm string, reg_dt string, writer string, article_title string, linked_summary_id long",
    )
    sdf = spark.createDataFrame(
        [(i, f, f"{d:%Y.%m.%d}", c, a) for i, f, d, c, a in summaries],
        "summary_id long, provider string, report_date string, company_name string, author string",
    )
    want = {}
    for i, f, d, w, t, linked in reports:
        fits = []
        for j, g, e, c, a in summaries:
            gap = int(f"{d:%Y%m%d}") - int(f"{e:%Y%m%d}") if compat else (d - e).days
            writer = (w or "").replace(", ", ".")
            if linked is None and f == g and -3 <= gap <= 5 and c in t and a.startswith(writer):
                fits.append((abs(gap), j))
        if fits:
            want[i] = (min(fits)[1], min(fits)[0], len(fits))
    got = M.match_summaries(rdf, sdf, compat=compat, inline_rows=inline_rows).collect()
    assert {r.report_id: (r.summary_id, r.gap, r.n_fitting) for r in got} == want
    assert len(got) == len(want)


def test_month_end(spark):
    r = spark.createDataFrame([(1, "F", "20260601", "", "acme up", None)], "report_id long, firm_nm string, reg_dt string, writer string, article_title string, linked_summary_id long")
    s = spark.createDataFrame([(9, "F", "2026.05.31", "acme", "x")], "summary_id long, provider string, report_date string, company_name string, author string")
    assert M.match_summaries(r, s).count() == 1
    assert M.match_summaries(r, s, compat=True).count() == 0


def test_consensus_median(spark):
    import statistics

    rng = random.Random(2)
    rows = [(i, 2026 + rng.randint(0, 1), rng.randint(1, 30)) for i in range(200)]
    tickers = {i: ["hot"] if rng.random() < 0.7 else [f"t{rng.randint(0, 3)}", "u"] for i, _, _ in rows}
    forecasts = spark.createDataFrame(rows, "report_id long, year int, sales int").withColumn("sales", F.col("sales").cast("decimal(18,2)"))
    reports = spark.createDataFrame(list(tickers.items()), "report_id long, stock_tickers array<string>")
    want = {}
    for i, y, v in rows:
        for k in tickers[i]:
            want.setdefault((k, y), []).append(v)
    got = {(r.ticker, r.year): (r.n_forecasts, r.mean_sales, r.median_sales) for r in G.forecast_consensus(reports, forecasts).collect()}
    assert got == {k: (len(v), round(sum(v) / len(v), 4), statistics.median(v)) for k, v in want.items()}

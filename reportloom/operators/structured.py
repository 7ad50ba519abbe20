"""Price target, revision, rating, tickers, analysts and report type of a title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lists import let
from ..functions.text import contains_any, empty_strings, quoted

# Price, action, opinion, job title and report type patterns.
PRICE_LABEL = r"(?:목표(?:주)?가|목표가격|적정(?:주)?가)\s*[:：]?\s*"
PRICE_COMPAT = r"\d{1,2}\s*만|\d{1,3}(?:,\d{3})*|\d{4,6}"
PRICE_FIXED = r"\d{1,2}\s*만|\d{4,6}|\d{1,3}(?:,\d{3})*"
ACTION = r"상향|하향|유지|신규|제시|상향조정|하향조정"
OPINION = r"BUY|HOLD|SELL|OUTPERFORM|NEUTRAL|UNDERPERFORM|매수|중립|매도|시장상회"
RATINGS = {
    "BUY": ("BUY", "매수", "OUTPERFORM", "시장상회"),
    "HOLD": ("HOLD", "중립", "NEUTRAL"),
    "SELL": ("SELL", "매도", "UNDERPERFORM"),
}
JOB_TITLES = r"책임연구원|선임연구원|수석연구원|연구원|애널리스트|선임|책임|위원|수석|Analyst"
WRITER_SPLIT = r"[,/\\|&+\s]+"
MACRO_WORDS = (
    "금리", "환율", "FOMC", "매크로", "인플레", "CPI", "연준", "채권", "외환", "시황", "전망", "지수", "전략",
    "자산배분", "퀀트", "파생",
)
QUANT_WORDS = ("퀀트", "계량", "시뮬레이션", "파생")
STRATEGY_WORDS = ("전략", "배분", "포트폴리오")
INDUSTRY_WORDS = (
    "반도체", "바이오", "헬스케어", "디스플레이", "2차전지", "배터리", "인터넷", "게임", "플랫폼", "금융",
    "자동차", "전기차", "철강", "화학", "정유", "엔터", "미디어", "화장품", "유통", "조선", "해운", "건설",
)
MACRO_FALLBACK_WORDS = ("전망", "리뷰", "캘린더")
LEAST_PRICE = 1000

# Blanks a claimed span; no name contains it.
CLAIMED = "\0"


def price_patterns(compat: bool = False) -> tuple[str, str]:
    """The labelled pattern and the one used only where it does not match."""
    price = PRICE_COMPAT if compat else PRICE_FIXED
    labelled = rf"(?U){PRICE_LABEL}({price})\s*원?\s*(?:으로\s*)?\s*({ACTION})?"
    bare = rf"(?U)({price})\s*원\s*(?:으로\s*)?\s*({ACTION})"
    return labelled, bare


def price_target(title: Column, compat: bool = False) -> Column:
    """struct<raw, action> of the price mention; fields are null where absent."""
    labelled, bare = price_patterns(compat)

    def part(pattern: str, group: int, present: Column) -> Column:
        return F.when(present, F.nullif(F.regexp_extract(title, pattern, group), F.lit("")))

    has_label = contains_any(title, ("목표", "적정"))
    has_won = F.contains(title, F.lit("원"))
    raw = part(labelled, 1, has_label)
    return F.struct(
        F.coalesce(raw, part(bare, 1, has_won)).alias("raw"),
        F.when(raw.isNotNull(), part(labelled, 2, has_label)).otherwise(part(bare, 2, has_won)).alias("action"),
    )


def price_value(raw: Column) -> Column:
    """Won as a whole number; null below the least credible price."""
    digits = F.translate(F.regexp_replace(raw, r"(?U)[,\s]", ""), "０１２３４５６７８９만", "0123456789")
    scale = F.when(F.contains(raw, F.lit("만")), F.lit(10000)).otherwise(F.lit(1))
    won = digits.try_cast("bigint") * scale
    return F.when(won >= LEAST_PRICE, won)


def revision_type(action: Column) -> Column:
    return (
        F.when(F.contains(action, F.lit("상향")), "UPGRADE")
        .when(F.contains(action, F.lit("하향")), "DOWNGRADE")
        .when(contains_any(action, ("신규", "제시")), "NEW")
        .otherwise("MAINTAIN")
    )


def rating(title: Column) -> Column:
    """BUY, HOLD or SELL by the first opinion word; BUY where there is none."""
    word = F.upper(F.regexp_extract(title, rf"(?iU)({OPINION})", 1))
    return (
        F.when(word.isin(*RATINGS["HOLD"]), "HOLD").when(word.isin(*RATINGS["SELL"]), "SELL").otherwise("BUY")
    )


def split_analysts(writer: Column) -> Column:
    """Names of 2 to 10 characters in order; job titles removed, repeats kept."""
    bare = F.regexp_replace(F.coalesce(writer, F.lit("")), rf"(?iU)\s*(?:{JOB_TITLES})", "")
    return F.filter(F.split(bare, f"(?U){WRITER_SPLIT}"), lambda n: F.length(n).between(2, 10))


def report_type(title: Column, tickers: Column) -> Column:
    upper = F.upper(title)
    return (
        F.when(F.size(tickers) > 0, "COMPANY")
        .when(
            contains_any(upper, MACRO_WORDS),
            F.when(contains_any(upper, QUANT_WORDS), "QUANT")
            .when(contains_any(upper, STRATEGY_WORDS), "STRATEGY")
            .otherwise("MACRO"),
        )
        .when(contains_any(upper, INDUSTRY_WORDS), "INDUSTRY")
        .when(contains_any(upper, MACRO_FALLBACK_WORDS), "MACRO")
        .otherwise("INDUSTRY")
    )


# ---- tickers -------------------------------------------------------------------


def direct_tickers(title: Column) -> Column:
    found = F.regexp_extract_all(title, F.lit(r"(?U)\((\d{6})\)"), F.lit(1))
    # most titles have no code: skip the scan
    return F.when(F.contains(title, F.lit("(")), found).when(title.isNotNull(), empty_strings())


def _starts(title: Column, name: Column) -> Column:
    """Offsets of the name read left to right without overlap with itself."""
    pieces = F.split(title, quoted(name), -1)
    return F.aggregate(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p) + F.length(name)).alias("at"),
            F.array_append(s["found"], s["at"] + F.length(p)).alias("found"),
        ),
        lambda s: s["found"],
    )


def claimed_tickers(title: Column, lex: Column) -> Column:
    """Codes of names that claim a span of the title no longer name has claimed."""
    return let(title, lambda t: _claims(t, lex))


def _claims(title: Column, lex: Column) -> Column:
    named = lambda e: e["ticker_rank"].isNotNull() & e["code"].isNotNull() & F.contains(title, e["word"])
    # a single name meets no rival
    alone = lambda present: F.when(F.size(present) <= 1, F.transform(present, lambda e: e["code"]))
    return let(F.filter(lex, named), lambda p: F.coalesce(alone(p), _claims_of(title, p)))


def _claims_of(title: Column, present: Column) -> Column:
    longest_first = F.sort_array(
        F.transform(
            present,
            lambda e: F.struct(
                (-F.length(e["word"])).alias("short"),
                e["ticker_rank"].alias("rank"),
                e["word"].alias("word"),
                e["code"].alias("code"),
                e["bordered"].alias("bordered"),
            ),
        )
    )

    def place(left: Column, e: Column) -> Column:
        """Where the name still stands in what is left of the title, 0 if nowhere."""
        width = F.length(e["word"])
        spans = F.filter(_starts(title, e["word"]), lambda a: F.substr(left, a + 1, width) == e["word"])
        # only a name that can overlap itself depends on how its places are counted
        return F.when(e["bordered"], F.coalesce(F.get(spans, F.lit(0)) + 1, F.lit(0))).otherwise(F.instr(left, e["word"]))

    def claim(state: Column, e: Column) -> Column:
        def step(at: Column) -> Column:
            blank = F.repeat(F.lit(CLAIMED), F.length(e["word"]))
            return F.when(
                at > 0,
                F.struct(
                    F.overlay(state["left"], blank, at).alias("left"),
                    F.array_append(state["codes"], e["code"]).alias("codes"),
                ),
            ).otherwise(state)

        return let(place(state["left"], e), step)

    start = F.struct(title.alias("left"), empty_strings().alias("codes"))
    return F.aggregate(longest_first, start, claim, lambda s: s["codes"])


def entity_tickers(title: Column, names: Column, lex: Column) -> Column:
    """Codes of extracted names that are not written in the title themselves."""


    def hits(row: Column) -> Column:
        return F.filter(
            lex,
            lambda e: e["ticker_rank"].isNotNull()
            & e["code"].isNotNull()
            & ~F.contains(row["title"], e["word"])
            & F.array_contains(row["names"], e["word"]),
        )

    found = let(F.struct(title.alias("title"), names.alias("names")), hits)
    return F.transform(found, lambda e: e["code"])


def tickers(title: Column, names: Column, lex: Column) -> Column:
    return F.sort_array(
        F.array_distinct(
            F.concat(direct_tickers(title), claimed_tickers(title, lex), entity_tickers(title, names, lex))
        )
    )


def with_analysts(df: DataFrame, writer: str = "writer", out: str = "analyst") -> DataFrame:
    """One row per analyst name of a report."""
    return df.select("*", F.explode(split_analysts(F.col(writer))).alias(out))

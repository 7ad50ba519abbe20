"""Company names in titles: coded, bracketed and dictionary mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import rules
from ..functions import dictionaries as D
from ..functions.lists import first_where, let, not_in
from ..functions.text import any_of, empty_strings, strip, whole_word

# Characters of a name, the code after it, and opinion words.
NAME_CHARS = r"가-힣A-Za-z&0-9\-"
CODE_TAIL = r"\(\s*(\d{5,6})(?:\.[A-Z]{2,4})?(?:/[가-힣A-Za-z&0-9/]+)?\s*\)"
OPINION_WORDS = (
    r"Buy|매수|Hold|중립|Sell|매도|Neutral|Reduce|Trading\s*Buy|Outperform|Underperform"
    r"|Marketperform|Overweight|Underweight"
)
LONGEST_NAME = 12
MAX_NAMES = 5

# A name is a whole run of name characters and spaces. Starting only where a run
# starts and never giving characters back keeps the scan linear.
CODED = rf"(?U)(?<![{NAME_CHARS}\s])\s*([{NAME_CHARS}][{NAME_CHARS}\s]*+){CODE_TAIL}"
BRACKET = rf"(?iU)\[([가-힣A-Za-z&0-9]+)\s*/\s*(?:{OPINION_WORDS})\]"

#: What names are found by, without sectors and tickers.
NAME_FIELDS = ["rank", "word", "code"]
LEXICON_SCHEMA = "rank int, word string, code string, sector string, ticker_rank int"


# ---- dictionaries -------------------------------------------------------------


def lexicon(table: DataFrame, inline_rows: int = D.INLINE_ROWS, sector_words: DataFrame | None = None) -> D.Dictionary:
    """A name table (rank, word, code, sector, ticker_rank), one row per name.

    ``rank`` is null for names that are looked up but never searched for;
    ``ticker_rank`` is null for names without a code. A name without a sector
    takes that of the sector word which it is: an alias is a name of a title
    that does not hold it, so its sector word is not found there.
    """
    if sector_words is not None:
        words = sector_words.groupBy("word").agg(F.max("sector").alias("_of_word"))
        table = table.join(words.hint("merge"), "word", "left").withColumn("sector", F.coalesce("sector", "_of_word"))
    # whether a proper beginning of the name is also its end
    ends = F.sequence(F.lit(1), F.greatest(F.length("word") - 1, F.lit(1)))
    bordered = (F.length("word") > 1) & F.exists(ends, lambda n: F.left("word", n) == F.right("word", n))
    return D.load(table.select("rank", "word", "code", "sector", "ticker_rank", bordered.alias("bordered")), inline_rows)


def seed_lexicon(spark: SparkSession) -> DataFrame:
    """The fixed name-to-code seeds as a lexicon table."""
    rows = [(i, name, code, None, i) for i, (name, code) in enumerate(rules.ticker_seeds())]
    return spark.createDataFrame(rows, LEXICON_SCHEMA)


def merge_lexicons(first: DataFrame, second: DataFrame) -> DataFrame:
    """Keep-first union of two (rank, word, code) tables; first comes before second."""
    rest = second.join(first.select("word"), "word", "left_anti")
    tagged = first.select(F.lit(0).alias("source"), "rank", "word", "code").unionByName(
        rest.select(F.lit(1).alias("source"), "rank", "word", "code")
    )
    return (
        tagged.groupBy("word")
        .agg(F.min(F.struct("source", "rank", "code")).alias("kept"))
        .select("word", "kept.source", "kept.rank", "kept.code")
    )


def _needed(table: DataFrame, fields: list[str]) -> DataFrame:
    """The rows of a name table that a title can need, with their ``place``; others of a name that comes often add nothing.

    Of each name and code the first row in the order of ``fields`` that has a rank, the first that has a sector and the
    first that has a ticker have place 1. Of the other rows with a ticker the n-th of a name claims something only in a
    title that has the name n times or more.
    """
    rows = table.select(*fields).repartition("word").distinct()
    given = {c: F.col(c).isNotNull() for c in ("rank", "sector") if c in fields}
    order = {c: fields for c in given}
    if "ticker_rank" in fields:
        given["ticker_rank"] = F.col("ticker_rank").isNotNull() & F.col("code").isNotNull()
        order["ticker_rank"] = ["ticker_rank", *fields]
    rows = rows.withColumns({f"_has_{c}": has for c, has in given.items()})
    spec = {c: W.partitionBy("word", "code", f"_has_{c}").orderBy(*order[c]) for c in given}
    rows = rows.withColumns({f"_first_{c}": F.col(f"_has_{c}") & (F.row_number().over(spec[c]) == 1) for c in given})
    place = F.when(any_of([F.col(f"_first_{c}") for c in given]), 1)
    if "ticker_rank" in fields:
        nth = F.row_number().over(W.partitionBy("word", "_has_ticker_rank").orderBy("ticker_rank", "code", *fields))
        rows = rows.withColumn("_nth", nth)
        place = place.when(F.col("_has_ticker_rank"), F.col("_nth"))
    return rows.select(*fields, place.alias("place")).where("place is not null")


def _probe(lex: D.Dictionary, fields: list[str] | None = None) -> D.Dictionary:
    """A large lexicon by name and by code: a code is searched like a word, and its row is what a title gets.

    A title that has a code alone needs the rows of place 1, and none if it has no parenthesis.
    """
    fields = fields or lex.entry.names
    name = f"probe {fields}"
    known = vars(lex)
    if name not in known:
        row = F.struct(*fields).alias("row")
        coded = F.when(F.col("code").isNotNull() & (F.col("place") == 1), F.col("code"))
        words = F.array(F.struct("word", "place"), F.struct(coded.alias("word"), F.lit(0).alias("place")))
        both = _needed(lex.table, fields).select(row, F.explode(words).alias("_of")).select("_of.word", "row", "_of.place")
        known[name] = D.Dictionary(both, both.schema, None, sent="row", place="place", only_with="(")
    return known[name]


def with_candidates(
    df: DataFrame,
    title: str,
    lex: D.Dictionary,
    out: str,
    key: str,
    more: dict[str, D.Dictionary] | None = None,
    tasks: int | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Add the lexicon rows a title could need: its name or its code is in the title.

    Every later step works on this short array only, so it does not matter
    whether it came from a literal or from a join. ``more`` names further
    dictionaries whose entries the title contains; the large ones share a join.
    ``tasks`` as for ``D.with_all_contained``. ``fields``: those that the caller
    reads, if not all; a large lexicon sends no others.
    """
    more = more or {}
    if lex.inline:
        # in name order, which decides aliases and the order of known names;
        # codes only count inside parentheses
        starts = {**lex.starts(), **lex.starts("code")}
        for d in more.values():
            starts |= d.starts() if d.inline else {}
        if starts:
            df = df.withColumn("_twos", F.expr(D.pairs_in(title, starts)))
        pairs = "_twos" if starts else None
        names, codes = lex.hits(title, pairs=pairs), lex.hits(title, "code", pairs)
        either = F.array_distinct(F.concat(names, codes))
        found = F.when(F.contains(F.col(title), F.lit("(")), either).otherwise(names)
        return D.with_all_contained(df, key, title, more, pairs).withColumn(out, F.sort_array(found)).drop("_twos")
    hits = D.with_all_contained(df, key, title, {"_probed": _probe(lex, fields)} | more, tasks=tasks)
    held = lambda t, word: (word != "") & F.contains(t, word)
    found = let(F.col(title), lambda t: F.filter("_probed", lambda e: held(t, e["word"]) | held(t, e["code"])))
    return hits.withColumn(out, F.sort_array(found)).drop("_probed")


# ---- column steps --------------------------------------------------------------


def coded_mentions(title: Column) -> Column:
    """array<struct<name, code>> of the coded names, stop names removed."""
    found = F.arrays_zip(
        F.regexp_extract_all(title, F.lit(CODED), F.lit(1)).alias("name"),
        F.regexp_extract_all(title, F.lit(CODED), F.lit(2)).alias("code"),
    )

    def cut(m: Column) -> Column:
        name = strip(m["name"])
        last = F.element_at(F.split(name, r"(?U)\s+"), -1)
        return F.struct(
            F.when(F.length(name) > LONGEST_NAME, last).otherwise(name).alias("name"),
            m["code"].alias("code"),
        )

    mentions = F.transform(found, cut)
    kept = F.filter(mentions, lambda m: (m["name"] != "") & ~m["name"].isin(*rules.stop_names()))
    # most titles have no code: skip both scans
    none = F.array().cast("array<struct<name:string,code:string>>")
    return F.when(F.contains(title, F.lit("(")), kept).otherwise(none)


def names_with_aliases(mentions: Column, lex: Column) -> Column:
    """Coded names, each followed by the first unused dictionary name of its code."""

    def add(names: Column, m: Column) -> Column:
        so_far = F.array_append(names, m["name"])
        alias = F.filter(
            lex,
            lambda e: (e["code"] == m["code"]) & e["rank"].isNotNull() & ~F.array_contains(so_far, e["word"]),
        )
        return F.concat(so_far, F.transform(F.slice(alias, 1, 1), lambda e: e["word"]))

    return F.aggregate(mentions, empty_strings(), add)


def bracket_names(title: Column) -> Column:
    names = F.regexp_extract_all(title, F.lit(BRACKET), F.lit(1))
    return F.when(F.contains(title, F.lit("[")), names).otherwise(empty_strings())


def known_names(title: Column, lex: Column, compat: bool = False) -> Column:
    """Dictionary names that stand as whole words in the title, in dictionary order."""
    hits = lambda t: F.filter(lex, lambda e: e["rank"].isNotNull() & whole_word(t, e["word"], compat))
    return F.transform(let(title, hits), lambda e: e["word"])


def drop_stop_names(names: Column) -> Column:
    return not_in(names, rules.stop_names())


def distinct_in_order(names: Column) -> Column:
    return F.array_distinct(names)


def entity_names(title: Column, lex: Column, compat: bool = False) -> Column:
    """All names of a title, not yet cut to the published length."""
    found = F.concat(
        names_with_aliases(coded_mentions(title), lex),
        bracket_names(title),
        known_names(title, lex, compat),
    )
    return distinct_in_order(drop_stop_names(found))


def sector_of_names(names: Column, lex: Column, sector_words: Column) -> Column:
    """The sector of the first name that has one, by name table and then by sector word."""


    def per_name(tables: Column) -> Column:
        return F.transform(
            names,
            lambda n: F.coalesce(
                first_where(tables["lex"], lambda e: (e["word"] == n) & e["sector"].isNotNull(), "sector"),
                first_where(tables["words"], lambda k: k["word"] == n, "sector"),
            ),
        )

    found = let(F.struct(lex.alias("lex"), sector_words.alias("words")), per_name)
    return first_where(found, lambda s: s.isNotNull())


# ---- DataFrame steps -------------------------------------------------------------


def entities_with_code(df: DataFrame, title: str = "article_title", out: str = "mentions") -> DataFrame:
    return df.withColumn(out, coded_mentions(strip(F.col(title))))


def entity_mentions(
    df: DataFrame,
    lex: D.Dictionary,
    title: str = "article_title",
    key: str = "report_id",
    out: str = "stock_names",
    compat: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    work = df.withColumn("_title", strip(F.col(title)))
    work = with_candidates(work, "_title", lex, "_lex", key, tasks=tasks, fields=NAME_FIELDS)
    return work.withColumn(out, entity_names(F.col("_title"), F.col("_lex"), compat)).drop("_title", "_lex")

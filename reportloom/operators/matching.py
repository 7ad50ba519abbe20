"""Join reports to third-party summaries, and carry links back.

A summary fits a report of the same firm when the title contains its company,
its date is at most 3 days later or 5 days earlier, and its author begins with
the report's writers. All four tests are turned into equality: dates and author
prefixes are expanded on the small summary side and reduced to the best summary
per key *before* the join. Each report then meets at most one row per company
in its title, so no day, firm or company can blow the join up.

Companies are looked for in the titles of their own firms and days only: a day of
few companies sends its titles the list, a day of many is met on short pieces of
the titles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import dictionaries as D
from ..functions.text import is_blank
from .candidates import summaries_missing_url

# Report date minus summary date.
LEAST_GAP, MOST_GAP = -3, 5
BACKLOG_DAYS = 180
KEYS = ["firm", "day", "company", "writer_key"]
#: Companies of a firm and day up to which their list is sent to the titles of that day.
LISTED = 256


def day_number(text: Column, compat: bool) -> Column:
    """Days since 1970; under ``compat`` the digits YYYYMMDD read as one number."""
    digits = F.replace(text, F.lit("."), F.lit(""))
    if compat:
        return digits.try_cast("int")
    return F.unix_date(F.try_to_date(digits, "yyyyMMdd"))


def report_side(reports: DataFrame, compat: bool = False) -> DataFrame:
    """Unlinked titled reports as (report_id, firm, day, writer_key, article_title)."""
    writer = F.coalesce(F.col("writer"), F.lit(""))
    return reports.where(F.col("linked_summary_id").isNull() & ~is_blank(F.col("article_title"))).select(
        "report_id",
        F.col("firm_nm").alias("firm"),
        day_number(F.col("reg_dt"), compat).alias("day"),
        F.replace(writer, F.lit(", "), F.lit(".")).alias("writer_key"),
        "article_title",
    )


def _writer_keys(reports: DataFrame, authors: DataFrame) -> DataFrame:
    """(firm, author, writer_key): which writer texts begin an author text.

    Both sides are first reduced to distinct people of a firm.
    """
    writers = reports.where("writer_key <> ''").select("firm", "writer_key").distinct()
    prefixes = authors.select(
        "firm",
        "author",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("author")), lambda n: F.substr("author", F.lit(1), n))
        ).alias("writer_key"),
    )
    named = prefixes.join(writers, ["firm", "writer_key"]).select("firm", "author", "writer_key")
    # a report without writers takes any author
    return named.unionByName(authors.select("firm", "author", F.lit("").alias("writer_key")))


def summary_rows(summaries: DataFrame, compat: bool = False) -> DataFrame:
    """Dated summaries of a company as (firm, summary_day, company, author, summary_id)."""
    return summaries.where(~is_blank(F.col("company_name"))).select(
        F.col("provider").alias("firm"),
        day_number(F.col("report_date"), compat).alias("summary_day"),
        F.col("company_name").alias("company"),
        F.coalesce("author", F.lit("")).alias("author"),
        "summary_id",
    ).where("summary_day is not null")


def summary_days(summaries: DataFrame) -> DataFrame:
    """Each summary under every day whose reports it may fit, with the distance in days."""
    gaps = F.explode(F.sequence(F.lit(LEAST_GAP), F.lit(MOST_GAP)))
    spread = summary_rows(summaries).select("firm", "company", "author", "summary_id", "summary_day", gaps.alias("_gap"))
    return spread.select("firm", "company", "author", "summary_id", F.abs("_gap").alias("gap"), (F.col("summary_day") + F.col("_gap")).alias("day"))


def best_pairs(pairs: DataFrame) -> DataFrame:
    """(report_id, summary_id, gap, n_fitting) of fitting pairs (report_id, summary_id, gap): the nearest in time, then the lowest id.

    A pair with ``n_fitting`` is the best of as many.
    """
    n = F.sum("n_fitting") if "n_fitting" in pairs.columns else F.count("*")
    best = pairs.groupBy("report_id").agg(F.min(F.struct("gap", "summary_id")).alias("best"), n.alias("n_fitting"))
    return best.select("report_id", "best.summary_id", "best.gap", "n_fitting")


def best_of_meetings(meetings: DataFrame, listed: int = LISTED) -> DataFrame:
    """(report_id, summary_id, gap, n_fitting) over blocks of reports and of summaries of one firm and day that meet.

    ``meetings`` has a number ``meeting``, ``firm``, ``reports`` (report_id, writer_key, article_title) and
    ``summaries`` (company, author, summary_id, gap); every report of a row is held against every summary of it. As
    in ``match_summaries`` a report meets one row per company in its title. The table is read more than once, so it
    should be a stored one.
    """
    by_company = meetings.select("meeting", "reports", F.array_distinct("summaries.company").alias("_companies"))
    few = F.size("_companies") <= listed
    held = F.filter("_companies", lambda c: F.contains("r.article_title", c))
    by_list = by_company.where(few).select("meeting", "_companies", F.explode("reports").alias("r")).select(
        "meeting", "r.report_id", "r.writer_key", F.explode_outer(held).alias("company")
    )
    many = by_company.where(~few)
    titles = many.select("meeting", F.posexplode("reports").alias("_at", "r")).select("meeting", F.struct("meeting", "_at").alias("row"), "r.*")
    by_piece = _hits_by_piece(titles, many.select("meeting", F.explode("_companies").alias("company")), ["meeting"], "row")
    hits = by_list.where("company is not null").unionByName(by_piece)
    rows = meetings.select("meeting", "firm", F.inline("summaries"))
    writers = meetings.select("firm", F.explode("reports.writer_key").alias("writer_key"))
    fitting = _under_writers(rows, writers).groupBy("meeting", "company", "writer_key").agg(
        F.min(F.struct("gap", "summary_id")).alias("best"), F.count("*").alias("n")
    )
    # what comes out of blocks has no honest size estimate and must not be broadcast
    return _best_of_hits(hits.join(fitting.hint("merge"), ["meeting", "company", "writer_key"]))


def _best_of_hits(joined: DataFrame) -> DataFrame:
    best = joined.groupBy("report_id").agg(F.min("best").alias("best"), F.sum("n").alias("n_fitting"))
    return best.select("report_id", "best.summary_id", "best.gap", "n_fitting")


def _under_writers(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Summaries under each writer text of their firm that begins their author, and under none."""
    authors = rows.where("author <> ''").select("firm", "author").distinct()
    keyed = rows.where("author <> ''").join(_writer_keys(reports, authors), ["firm", "author"])
    return keyed.unionByName(rows.where("author = ''").withColumn("writer_key", F.lit("")))


def _summary_side(summaries: DataFrame, reports: DataFrame, compat: bool) -> DataFrame:
    """One row per (firm, day, company, writer_key): the best summary and how many fit."""
    rows = summary_rows(summaries, compat)
    # copies that differ in id only: the lowest id stands for all
    rows = rows.groupBy("firm", "summary_day", "company", "author").agg(
        F.min("summary_id").alias("summary_id"), F.count("*").alias("n")
    )
    gaps = F.explode(F.sequence(F.lit(LEAST_GAP), F.lit(MOST_GAP)))
    spread = _under_writers(rows, reports).select("*", gaps.alias("gap")).withColumn("day", F.col("summary_day") + F.col("gap"))
    return spread.groupBy(*KEYS).agg(
        F.min(F.struct(F.abs("gap").alias("gap"), "summary_id")).alias("best"), F.sum("n").alias("n")
    )


def _company_hits(side: DataFrame, summaries: DataFrame, compat: bool, listed: int) -> DataFrame:
    """The report side with each company of its firm and day that its title contains, one row each."""
    rows = summary_rows(summaries, compat).select("firm", "company", "summary_day").distinct()
    days = F.explode(F.sequence(F.lit(LEAST_GAP), F.lit(MOST_GAP)))
    companies = rows.select("firm", "company", days.alias("_gap"), "summary_day")
    companies = companies.select("firm", (F.col("summary_day") + F.col("_gap")).alias("day"), "company").distinct()
    # no day collects more than one company beyond the limit: the rank filter runs before the shuffle
    first = companies.withColumn("_rank", F.row_number().over(W.partitionBy("firm", "day").orderBy("company"))).where(F.col("_rank") <= listed + 1)
    lists = first.groupBy("firm", "day").agg(F.collect_list("company").alias("_companies"))
    held = F.filter("_companies", lambda c: F.contains("article_title", c))
    # outer, for otherwise a filter on the list is derived and it is computed twice
    by_list = side.join(lists.where(F.size("_companies") <= listed), ["firm", "day"]).select(
        "report_id", "firm", "day", "writer_key", F.explode_outer(held).alias("company")
    )
    many = lists.where(F.size("_companies") > listed).select("firm", "day")
    day = ["firm", "day"]
    by_piece = _hits_by_piece(side.join(many, day, "left_semi"), companies.join(many, day, "left_semi"), day, "report_id")
    return by_list.where("company is not null").unionByName(by_piece)


def _hits_by_piece(side: DataFrame, companies: DataFrame, day: list[str], key: str) -> DataFrame:
    """The same for days of many companies: each lies under that piece of its name which the fewest of its day share."""
    pieces = companies.select(*day, "company", F.explode(D.pieces_of(F.col("company"))).alias("_gram"))
    shared = pieces.groupBy(*day, "_gram").agg(F.count("*").alias("n"))
    lying = pieces.join(shared, [*day, "_gram"]).groupBy(*day, "company").agg(F.min_by("_gram", F.struct("n", "_gram")).alias("_gram"))
    titles = side.select(key, *day, F.explode(D.grams_of(F.col("article_title"))).alias("_gram"))
    some = titles.join(lying.hint("merge"), [*day, "_gram"]).select(key, "company")
    found = side.join(some, key).where(F.contains("article_title", "company"))
    return found.select("report_id", *day, "writer_key", "company")


def match_summaries(
    reports: DataFrame,
    summaries: DataFrame,
    first_day: str | None = None,
    last_day: str | None = None,
    compat: bool = False,
    inline_rows: int = LISTED,
) -> DataFrame:
    """(report_id, summary_id, gap, n_fitting), one row per matched unlinked report.

    Of several fitting summaries the one nearest in time wins, then the lowest
    id. ``first_day``/``last_day`` (YYYYMMDD) bound the report date. ``compat``
    subtracts YYYYMMDD numbers, which loses matches across month ends. Nothing
    runs before the result is asked for. Days of a firm with more companies than
    ``inline_rows`` are met by pieces.
    """
    if first_day is not None:
        reports = reports.where(F.col("reg_dt") >= first_day)
    if last_day is not None:
        reports = reports.where(F.col("reg_dt") <= last_day)
    side = report_side(reports, compat)
    fitting = _summary_side(summaries, side, compat)
    return _best_of_hits(_company_hits(side, summaries, compat, inline_rows).join(fitting, KEYS))


def match_backlog(reports: DataFrame, summaries: DataFrame, today: str, days: int = BACKLOG_DAYS, **options) -> DataFrame:
    """All reports of the ``days`` days before ``today`` (YYYYMMDD) in one join."""
    here = F.to_date(F.lit(today), "yyyyMMdd")
    text = lambda day: F.date_format(day, "yyyyMMdd")
    window = reports.where(
        (F.col("reg_dt") >= text(F.date_sub(here, days))) & (F.col("reg_dt") <= text(F.date_sub(here, 1)))
    )
    return match_summaries(window, summaries, **options)


def link_reports(reports: DataFrame, matches: DataFrame) -> DataFrame:
    """Store the matches; an existing link is kept."""
    found = matches.select("report_id", F.col("summary_id").alias("_found"))
    linked = F.coalesce("linked_summary_id", "_found").alias("linked_summary_id")
    cols = [linked if c == "linked_summary_id" else F.col(c) for c in reports.columns]
    return reports.join(found, "report_id", "left").select(*cols)


def propagate_pdf_url(summaries: DataFrame, reports: DataFrame, n: int | None = None) -> DataFrame:
    """Fill every empty ``pdf_url`` that a linked report can give; with ``n`` only the lowest such summaries.

    The newest linked report wins. Reports are reduced to one URL per summary
    before they meet the summaries. With ``n`` only fillable summaries count, so
    that those without a report never block the rest.
    """
    targets = summaries_missing_url(summaries)
    if n is not None:
        able = reports.where(~is_blank(F.col("telegram_url"))).select(F.col("linked_summary_id").alias("summary_id"))
        targets = targets.join(able, "summary_id", "left_semi").orderBy("summary_id").limit(n)
    urls = (
        reports.where(F.col("linked_summary_id").isNotNull() & ~is_blank(F.col("telegram_url")))
        .select(F.col("linked_summary_id").alias("summary_id"), "report_id", "telegram_url")
        .join(targets, "summary_id", "left_semi")
        .groupBy("summary_id")
        .agg(F.max_by("telegram_url", "report_id").alias("_url"))
    )
    filled = F.coalesce("_url", "pdf_url").alias("pdf_url")
    cols = [filled if c == "pdf_url" else F.col(c) for c in summaries.columns]
    return summaries.join(urls, "summary_id", "left").select(*cols)


def report_analysts_read(bridge: DataFrame, analysts: DataFrame, reports: DataFrame) -> DataFrame:
    """Analyst names of the given reports, sorted."""
    names = (
        bridge.join(reports.select("report_id"), "report_id", "left_semi")
        .join(analysts.select("analyst_id", "name"), "analyst_id")
        .groupBy("report_id")
        .agg(F.array_sort(F.collect_set("name")).alias("names"))
    )
    return names


def report_forecasts_read(forecasts: DataFrame, reports: DataFrame) -> DataFrame:
    return forecasts.join(reports.select("report_id"), "report_id").select(
        "report_id", "year", "sales", "operating_profit"
    )

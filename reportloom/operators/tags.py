"""Topic tags and action of a title, and the clean-up that makes the published lists."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import dictionaries as D
from ..functions.lists import let, listed, literal_list
from ..functions.text import empty_strings, fold

# The default company label and the published list lengths.
COMPANY_LABEL = "기업 분석"
MAX_TAGS = 8

_FLAGS = "(?iUd)"


def _tests(pack) -> dict[str, list[tuple[int, str | None]]]:
    """Per literal of the pack the rules to try where a title holds it: rank and regex, none where the literal alone decides."""
    known: dict[str, list[tuple[int, str | None]]] = {}
    for rank, rule in enumerate(pack):
        pieces: dict[str, list[str]] = {}
        for literal, piece in rule.gated:
            pieces.setdefault(literal, []).append(piece)
        for word in rule.words:
            known.setdefault(word, []).append((rank, None))
        for literal, alternatives in pieces.items():
            known.setdefault(literal, []).append((rank, _FLAGS + "|".join(alternatives)))
    return known


def with_rule_text(df: DataFrame, title: str, *packs) -> DataFrame:
    """Add what the rules look at: ``_folded`` and ``_pairs``.

    ``_pairs`` holds those character pairs of the title that some rule's
    literal begins with. They select the few rules that are tested at all.
    """
    packs = packs or (rules.tag_rules(), rules.action_rules())
    starts = sorted({text[:2] for pack in packs for text in _tests(pack) if len(text) > 1})
    known = F.expr(D.pairs_in("_folded", starts)) if starts else empty_strings()
    return df.withColumn("_folded", fold(F.col(title))).withColumn("_pairs", known)


def _matching(title: str, *packs) -> Column:
    """Ranks of the matching rules in no order, each once or more; those of a further pack count on from the last.

    A table of the plan names the rules under the first pair of each of their
    literals, so the work grows with what a title holds and not with the number
    of rules. One expression per rule would make a method of more code than the
    JVM compiles. Tests go by number, since each step over structs copies them.
    """
    by_start: dict[str, list[int]] = {}
    always: list[int] = []
    literals, regexes, ranks = [], [], []
    before = 0
    for pack in packs:
        for literal, tests in _tests(pack).items():
            numbers = by_start.setdefault(literal[:2], []) if len(literal) > 1 else always
            for rank, regex in tests:
                numbers.append(len(ranks))
                literals.append(literal)
                regexes.append(regex)
                ranks.append(before + rank)
        before += len(pack)
    picked = F.flatten(F.transform("_pairs", listed(by_start, "int")))
    if always:
        picked = F.concat(picked, F.array(*[F.lit(i) for i in always]))
    literal, regex = literal_list(literals), literal_list(regexes)

    def passing(t: Column) -> Column:
        tried = lambda i: F.get(regex, i).isNull() | F.rlike(t["title"], F.get(regex, i))
        return F.filter(picked, lambda i: F.contains(t["folded"], F.get(literal, i)) & tried(i))

    found = let(F.struct(F.col("_folded").alias("folded"), F.col(title).alias("title")), passing)
    return F.transform(found, lambda i: F.get(F.from_json(F.lit(json.dumps(ranks)), "array<int>"), i))


def _label(ranks: Column, pack) -> Column:
    return F.get(F.array(*[F.lit(rule.label) for rule in pack]).cast("array<string>"), ranks)


def matching_labels(title: str, pack=None) -> Column:
    """Labels of all matching rules in rule order, each once.

    For a DataFrame that went through ``with_rule_text``; ``title`` names its
    column. A null title has none.
    """
    pack = rules.tag_rules() if pack is None else pack
    ranks = F.sort_array(F.array_distinct(F.coalesce(_matching(title, pack), F.array().cast("array<int>"))))
    return F.array_distinct(F.transform(ranks, lambda rank: _label(rank, pack)))


def labels_and_action(matching: Column, tag_pack, action_pack) -> tuple[Column, Column]:
    """``matching_labels`` and ``first_label`` from one column of ``matching_rules``."""
    n = len(tag_pack)
    ranks = F.sort_array(F.array_distinct(F.filter(matching, lambda rank: rank < n)))
    labels = F.array_distinct(F.transform(ranks, lambda rank: _label(rank, tag_pack)))
    return labels, _label(F.array_min(F.filter(matching, lambda rank: rank >= n)) - n, action_pack)


def matching_rules(title: str, tag_pack, action_pack) -> Column:
    """Ranks of all matching rules of both packs, met in one pass; for ``labels_and_action``."""
    return F.coalesce(_matching(title, tag_pack, action_pack), F.array().cast("array<int>"))


def first_label(title: str, pack=None) -> Column:
    """Label of the first matching rule, else null."""
    pack = rules.action_rules() if pack is None else pack
    return _label(F.array_min(_matching(title, pack)), pack)


def merge_action(tags: Column, action: Column) -> Column:
    """The action leads unless the tags already hold it."""
    lead = F.when(action.isNotNull(), F.array(action)).otherwise(empty_strings())
    return F.array_distinct(F.concat(F.array_except(lead, tags), tags))


def suppress_sector_overlap(tags: Column, sector: Column) -> Column:
    """Drop what the sector already says; a longer, more specific tag stays."""

    def keep(s: Column) -> Column:
        return F.filter(tags, lambda t: (s == "") | ~((t == s) | ((F.length(t) >= 2) & F.contains(s, t))))

    return let(F.coalesce(sector, F.lit("")), keep)


def suppress_entity_overlap(tags: Column, names: Column) -> Column:
    """Drop tags that equal, contain or are part of a company name."""


    def keep(found: Column) -> Column:
        return F.filter(
            tags,
            lambda t: ~F.exists(
                found,
                lambda n: (t == n) | ((F.length(t) >= 2) & (F.contains(n, t) | F.contains(t, n))),
            ),
        )

    return let(names, keep)


def default_company_tag(tags: Column, names: Column) -> Column:
    default = F.when(F.size(names) > 0, F.array(F.lit(COMPANY_LABEL))).otherwise(empty_strings())
    return F.array_distinct(F.concat(tags, default))


def clip(items: Column, most: int) -> Column:
    return F.slice(items, 1, most)


def badge_tags(tags: Column, sector: Column, names: Column) -> Column:
    """Tags worth a badge next to the sector and the names."""
    return F.filter(tags, lambda t: ~((t == F.coalesce(sector, F.lit(""))) | F.array_contains(names, t)))

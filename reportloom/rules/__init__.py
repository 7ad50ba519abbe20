"""Rule packs: ordered (label, pattern) lists and word lists kept as plain text.

Every pack is small and fixed, so it becomes literals inside the plan. Name
tables and larger word tables are DataFrames instead; see
``functions.dictionaries``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from importlib import resources


@dataclass(frozen=True)
class Rule:
    """One labelled pattern, split so that most titles never reach a regex.

    ``words`` are alternatives without any regex syntax: containing one (case
    folded) is already a match. ``gated`` pairs each remaining alternative with
    a literal every match of it must contain ('' where there is none).
    """

    rank: int
    label: str
    pattern: str
    words: tuple[str, ...]
    gated: tuple[tuple[str, str], ...]


_GAP = "\x00"
# What may match something other than its own text: groups, classes, escapes
# with a class, optional characters, wildcards and edges.
_NOT_LITERAL = re.compile(
    r"\((?:\?(?:[:=!]|<[=!]))?[^()]*\)[?*+]?"
    r"|\[[^\]]*\](?:[?*+]|\{[\d,]+\})?"
    r"|\\[sdwbSDWB](?:[?*+]|\{[\d,]+\})?"
    r"|\\?.[?*]\??"
    r"|[.^$]"
)


def _alternatives(pattern: str) -> list[str]:
    """Split at the bars outside parentheses."""
    parts, depth = [""], 0
    for ch in pattern:
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += ch
    return parts


def required_text(alternative: str) -> str:
    """The longest literal that every match of the alternative contains."""
    plain = re.sub(r"\\([^\w\s])", r"\1", _NOT_LITERAL.sub(_GAP, alternative))
    return max(plain.split(_GAP), key=len)


def compile_rule(rank: int, label: str, pattern: str) -> Rule:
    # An escaped parenthesis would upset the depth count; such a rule stays whole
    # and has no literal to look for first.
    irregular = re.search(r"\\[()]", pattern) is not None
    pieces = [pattern] if irregular else _alternatives(pattern)
    is_regex = re.compile(r"[\\()\[\]{}.?*+^$]").search
    found = {p.lower() for p in pieces if not is_regex(p)}
    words = tuple(w for w in dict.fromkeys(p.lower() for p in pieces) if w in found
                  and not any(o != w and o in w for o in found))
    gated: dict[str, tuple[str, str]] = {}
    for piece in filter(is_regex, pieces):
        literal = "" if irregular else required_text(piece).lower()
        if any(w in literal for w in words):
            continue  # the word alone already decides
        same = piece if re.search(r"\\[A-Z]", piece) else piece.lower()
        gated.setdefault(same, (literal, piece))
    return Rule(rank, label, pattern, words, tuple(gated.values()))


def _lines(name: str) -> list[str]:
    text = resources.files(__name__).joinpath(name).read_text(encoding="utf-8")
    return [ln for ln in text.splitlines() if ln and not ln.startswith("# ")]


def _pairs(name: str) -> list[tuple[str, str]]:
    return [tuple(ln.split("\t", 1)) for ln in _lines(name)]


def rules_from_pairs(pairs) -> tuple[Rule, ...]:
    return tuple(compile_rule(i, label, pattern) for i, (label, pattern) in enumerate(pairs))


@cache
def tag_rules() -> tuple[Rule, ...]:
    return rules_from_pairs(_pairs("tag_rules.tsv"))


@cache
def action_rules() -> tuple[Rule, ...]:
    return rules_from_pairs(_pairs("action_rules.tsv"))


@cache
def stop_names() -> tuple[str, ...]:
    return tuple(w.strip() for ln in _lines("stop_names.txt") for w in ln.split(","))


@cache
def ticker_seeds() -> tuple[tuple[str, str], ...]:
    return tuple(_pairs("ticker_seeds.tsv"))

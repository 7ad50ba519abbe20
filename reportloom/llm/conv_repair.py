"""Conversation structure repair: lightest derivations over weighted deductions, popped from an agenda (Knuth 1977)."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of texts: ``[\x20\x09-\x0D]``.
WHITE = "\t\n\x0b\x0c\r "
#: Costs of edits; a truncated row that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States after some rows: nothing yet, or the initial of the last role. A conversation may end in OPEN or after an answer.
OPEN = "0"
#: Which initials may be kept in a state, and the role a rewritten or inserted row gets.
KEEPS = {OPEN: "su", "s": "u", "u": "a", "a": "u"}
GIVES = {OPEN: "user", "s": "user", "u": "assistant", "a": "user"}
#: Rows of a conversation that one agenda works on.
BLOCK_ROWS = 128

Weight = tuple[int, str]
Deduction = tuple[tuple, tuple, Callable[..., Weight]]


def lightest(axioms: Iterable[tuple[tuple, Weight]], deductions: list[Deduction], goal: tuple | None = None) -> dict[tuple, Weight]:
    """The lightest weight of every item that can be derived, as far as the goal needs it.

    A deduction (antecedents, consequent, function) is an edge of a hypergraph. Functions are superior: the result is no
    lighter than any argument and grows with each. So the lightest item of the agenda is final when popped, and the
    search ends with the goal.
    """
    waiting = [len(set(antecedents)) for antecedents, _, _ in deductions]
    needs: dict[tuple, list[int]] = {}
    for k, (antecedents, _, _) in enumerate(deductions):
        for item in set(antecedents):
            needs.setdefault(item, []).append(k)
    agenda = [(weight, item) for item, weight in axioms]
    heapq.heapify(agenda)
    final: dict[tuple, Weight] = {}
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for k in needs.get(item, ()):
            waiting[k] -= 1
            if not waiting[k]:
                antecedents, consequent, combine = deductions[k]
                if consequent not in final:
                    heapq.heappush(agenda, (combine(*(final[x] for x in antecedents)), consequent))
    return final


def _edit(cost: int, letter: str) -> Callable[..., Weight]:
    """An edit after a derivation; the row it uses up, if any, weighs nothing."""
    return lambda before, row=None: (before[0] + cost, before[1] + letter)


_INSERT = _edit(INSERT, "I")
_DELETE = _edit(DELETE, "D")
_KEEP = {late: _edit(TRUNCATED * late, "K") for late in (0, 1)}
_REROLE = {late: _edit(REROLE + TRUNCATED * late, "R") for late in (0, 1)}


def edits(rows: list[tuple[str, str]], ends: bool) -> list[Deduction]:
    """All deductions over rows (fault, initial): item (k, state) is the first k rows repaired so far, (k,) is row k itself.

    Without ``ends`` nothing is inserted after the last row: what follows does it in front of its own first row.
    """
    out: list[Deduction] = []
    for k in range(len(rows) + ends):
        out += [(((k, q),), (k, GIVES[q][0]), _INSERT) for q in KEEPS]
    for k, (fault, initial) in enumerate(rows):
        late = int(fault == "truncated")
        for q in KEEPS:
            out.append((((k, q), (k,)), (k + 1, q), _DELETE))
            if fault in ("", "truncated"):
                out.append((((k, q), (k,)), (k + 1, GIVES[q][0]), _REROLE[late]))
                if initial and initial in KEEPS[q]:
                    out.append((((k, q), (k,)), (k + 1, initial), _KEEP[late]))
    if ends:
        out += [(((len(rows), q),), ("goal",), lambda before: before) for q in (OPEN, "a")]
    return out


class Repair:
    """One conversation, taken row by row; holds one block of rows and at most four partial audits.

    Between blocks an audit is replaced by its rank among the four. That keeps their order, since none that ends with
    a used-up row is a prefix of another one of the same cost.
    """

    def __init__(self):
        self.rows: list[tuple[str, str]] = []
        #: state: (cost, chain of audit pieces), lightest first
        self.front: list[tuple[str, int, tuple | None]] = [(OPEN, 0, None)]

    def add(self, fault: str, initial: str) -> None:
        self.rows.append((fault, initial))
        if len(self.rows) == BLOCK_ROWS:
            self._close(False)

    def _close(self, ends: bool):
        n = len(self.rows)
        axioms = [((k,), (0, "")) for k in range(n)]
        axioms += [((0, q), (cost, chr(rank))) for rank, (q, cost, _) in enumerate(self.front)]
        final = lightest(axioms, edits(self.rows, ends), ("goal",) if ends else None)
        self.rows = []
        found = [(q, final[x]) for q in KEEPS if (x := ("goal",) if ends else (n, q)) in final]
        found.sort(key=lambda f: f[1][1])  # by audit: ranks stand for the order of audits alone
        self.front = [(q, cost, (self.front[ord(audit[0])][2], audit[1:])) for q, (cost, audit) in found]

    def result(self) -> Weight:
        """(cost, audit) of the cheapest repair, the ASCII-least of equals."""
        self._close(True)
        _, cost, chain = self.front[0]
        pieces = []
        while chain:
            chain, piece = chain
            pieces.append(piece)
        return cost, "".join(reversed(pieces))


# ---- rows ------------------------------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """Rows as a fixed rule spoils them, by crc32 of ``conv_id:turn`` modulo 20; null parts of it, roles and texts are one space.

    0: dropped; 1: empty text; 2: without its ``. ! ?``; 3: twice, one after the other; 4: said by the user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    rows = turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), kind.alias("kind__"))
    times = F.when(F.col("kind__") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("kind__ <> 0").withColumn("copy__", F.explode(times)).select("conv_id", "turn", "role", "text")


def _sorted(rows: DataFrame, first: str) -> DataFrame:
    """Rows dealt by conversation, each in its order: turn (nulls first), role, digest; ``first`` before equals."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest", first)


def _turn_key() -> Column:
    return F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))


def _noted(turns: DataFrame) -> DataFrame:
    """Rows with null roles and texts as empty strings, and the digest that says whether two are the same."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), digest.alias("digest"))


def _seen_before(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest) of rows that an earlier turn of the conversation has too.

    Grouped by digest and met again by turn, so that a text said in every turn of a large conversation is no hot key.
    """
    said = rows.select("conv_id", "turn", "role", "digest").distinct()
    firsts = said.groupBy("conv_id", "digest").agg(F.min(_turn_key()).alias("t")).select(F.col("conv_id").alias("c"), F.col("t.turn").alias("t"), F.col("digest").alias("d"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("digest") == F.col("d"))
    return said.join(firsts, same, "left_anti")


def _stream(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    some = []
    for r in rows:
        some.append(r)
        if len(some) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _ids(df: DataFrame) -> tuple[str, pa.DataType]:
    kind = df.schema["conv_id"].dataType.simpleString()
    return kind, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def plan(turns: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults and illegal neighbours of its rows, and its cheapest repair (cost, audit).

    ``turns`` has conv_id (bigint, int or string; null is a conversation too), turn, role, text. Rows are taken by turn, nulls
    first, then role and digest, so the result does not depend on the order of the table; repeated rows are repeated turns.
    Null roles and texts are empty. Other columns are not read; an empty table gives an empty result.

    A row's fault is the first of: blank (no ``[^\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier), truncated (the last
    such character is none of ``. ! ?``). gaps: largest turn - smallest + 1 - distinct turns, nulls left out; 0 if all are null.
    illegal: neighbouring role initials other than su, ua, au. Edits: Keep 0, Rerole 3 (to user or assistant), Delete 4 (always for blank
    and duplicate rows), Insert 3 (an empty user or assistant row); truncated rows that stay cost 3 more. The repaired
    initials are ``(s?(ua)+)?``. ``audit`` has the initials of the edits in order, the ASCII-least of the cheapest.

    Only digests and flags are dealt by conversation; a task reads its conversations as a sorted stream and holds one
    block of rows and four partial audits of one, whatever its size.
    """
    rows = _noted(turns)
    bare = F.rtrim("text", F.lit(WHITE))
    marks = F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    own = rows.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), marks.alias("fault"))
    noted = _seen_before(rows).select("conv_id", "turn", "role", "digest", F.lit(None).cast("string").alias("initial"), F.lit(None).cast("string").alias("fault"))
    ordered = _sorted(own.unionByName(noted), "initial").select("conv_id", "turn", "digest", "initial", "fault")
    kind, arrow = _ids(turns)
    schema = pa.schema([("conv_id", arrow), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])

    def run(batches):
        def solve():
            none = object()
            conv = none
            for c, turn, digest, initial, fault in _stream(batches):
                if conv is none or c != conv:
                    if conv is not none:
                        yield done()
                    conv, own, n = c, Repair(), dict.fromkeys(COUNTS, 0)
                    low = high = last = seen = None
                    turns_, before = 0, None
                if initial is None:  # what an earlier turn has, noted in front of its rows
                    seen = (turn, digest)
                    continue
                if fault != "blank" and (turn, digest) == seen:
                    fault = "duplicate"
                seen = (turn, digest)
                if turn is not None:
                    if turn != last:
                        turns_ += 1
                    low, high, last = turn if low is None else low, turn, turn
                if fault:
                    n[fault] += 1
                if before is not None and before + initial not in ("su", "ua", "au"):
                    n["illegal"] += 1
                before = initial
                own.add(fault, initial)

                def done(own=own, n=n):
                    n["gaps"] = 0 if low is None else high - low + 1 - turns_
                    n["cost"], audit = own.result()
                    return (conv, *n.values(), audit)

            if conv is not none:
                yield done()

        yield from _batches(solve(), schema)

    return ordered.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, audit string")


def apply(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of every conversation after the edits of its audit, place from 1.

    ``audits`` (conv_id, audit) as ``plan`` gives them for the same rows; a conversation without one keeps no rows. Rows of a
    conversation come in order, in one partition; a task holds one row and one audit.
    """
    rows = _noted(turns).withColumn("audit", F.lit(None).cast("string")).withColumn("header", F.lit(1))
    heads = audits.select("conv_id", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("binary").alias("digest"), "audit", F.lit(0).alias("header"))
    # a header is the first row of its conversation
    ordered = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "header", F.col("turn").asc_nulls_first(), "role", "digest")
    kind, arrow = _ids(turns)
    schema = pa.schema([("conv_id", arrow), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run(batches):
        def written():
            none = object()
            conv, audit, at, state, place = none, "", 0, OPEN, 0

            def inserted():
                nonlocal at, state, place
                while at < len(audit) and audit[at] == "I":
                    at, place = at + 1, place + 1
                    role = GIVES[state]
                    state = role[0]
                    yield conv, place, "I", role, ""

            for c, role, text, plan_, header in _stream(batches):
                if conv is none or c != conv:
                    yield from inserted()
                    conv, audit, at, state, place = c, "", 0, OPEN, 0
                if not header:
                    audit = plan_
                    continue
                yield from inserted()
                edit, at = audit[at : at + 1] or "D", at + 1
                if edit != "D":
                    role, place = GIVES[state] if edit == "R" else role, place + 1
                    state = role[0]
                    yield conv, place, edit, role, text
            yield from inserted()

        yield from _batches(written(), schema, 500)

    return ordered.select("conv_id", "role", "text", "audit", "header").mapInArrow(run, f"conv_id {kind}, place bigint, edit string, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the rows of ``apply``: lines ``role:text`` with newlines between. A running digest per task."""
    kind, arrow = _ids(repaired)
    schema = pa.schema([("conv_id", arrow), ("repaired_sha256", pa.string())])

    def run(batches):
        def read():
            none = object()
            conv = none
            for c, role, text in _stream(batches):
                if conv is none or c != conv:
                    if conv is not none:
                        yield conv, sha.hexdigest()
                    conv, sha = c, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if conv is not none:
                yield conv, sha.hexdigest()

        yield from _batches(read(), schema)

    return repaired.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``plan`` and the digest of what ``apply`` makes of it, one row per conversation of ``conversations`` (or of ``turns``).

    A conversation without rows has zeros, an empty audit and the digest of the empty string.
    """
    audits = plan(turns)
    read = digests(apply(turns, audits.select("conv_id", "audit")))
    ids = (turns if conversations is None else conversations).select(F.col("conv_id").alias("id")).distinct()
    same = lambda df: F.col("id").eqNullSafe(df["conv_id"])
    both = ids.join(audits, same(audits), "left").drop("conv_id")
    both = both.join(read, same(read), "left").drop("conv_id")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS]
    nothing = hashlib.sha256().hexdigest()
    return both.select(F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))

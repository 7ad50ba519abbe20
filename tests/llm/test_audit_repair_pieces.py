"""Filter interaction audit, conversation repair, SentencePiece pieces."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from reportloom.llm import conv_repair, filter_audit, pieces

from .brute import WORD

MODEL = public_tokenizers.path("piece_bpe_32k.model")

# ---- pieces ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.read_model(MODEL))


def test_pieces_equal_the_library(odd_docs, docs, library):
    for df in (odd_docs, docs):
        texts = {r.doc_id: r.text or "" for r in df.collect()}
        got = pieces.encode(df, MODEL).collect()
        assert len(got) == df.count()
        for r in got:
            want = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
            assert r.ids == want and r.n_tokens == len(want)
            assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "▁", "a", "e", "n", "the", " the", "ing", "é", "ö", "日本", "\n", "\t", "\x00", "1", "20", ",", "<s>", "<0x0A>", "\U0001f600", "x" * 20]), max_size=40))
def test_any_text_round_trips_as_the_library(library, codec, some):
    text = "".join(some)
    ids = [i for x in codec.encode(text) for i in x]
    assert ids == library.encode(text, add_bos=True, add_eos=True)
    assert b"".join(codec.decode(iter([ids]))).decode() == library.decode(ids)


def test_backtracking_leaves_what_merging_leaves(codec):
    rnd = random.Random(11)
    for _ in range(1500):
        word = "".join(rnd.choices("▁aeinrsthdg", weights=(1, 3, 4, 3, 3, 2, 2, 3, 2, 1, 2), k=rnd.randint(1, 40)))
        assert codec.backtrack(word) == codec.merge(word)


def test_backtracking_gives_way(spark):
    # merging makes ab first, so the longest match bc at its place and abc as a whole can never stand
    own = pieces.Codec((["a", "b", "c", "d", "ab", "bcd", "cd"], [-9.0, -9.0, -9.0, -9.0, -1.0, -2.0, -3.0], [10, 11, 12, 13, 14, 15, 16], {b: 300 + b for b in range(256)}, (1, 2)))
    for word in ("abcd", "bcd", "dabcdab", "aabbccdd"):
        assert own.backtrack(word) == own.merge(word)
    assert own.backtrack("abcd") == ["ab", "cd"]


def test_pieces_in_slices(library, codec, monkeypatch):
    text = "  the quick\nbrown fox, " * 300 + " " * 50 + "end" + "y" * 500
    want = library.encode(text, add_bos=True, add_eos=True)
    monkeypatch.setattr(pieces, "SLICE_CHARS", 7)
    slices = list(codec.encode(text))
    assert len(slices) > 100 and [i for x in slices for i in x] == want
    monkeypatch.setattr(pieces, "WORDS_MOST", 3)
    monkeypatch.setattr(pieces, "PAIRS_MOST", 3)
    assert [i for x in codec.encode(text) for i in x] == want


def test_pieces_without_a_break(library, codec):
    text = "ab" * 100_000
    assert [i for x in codec.encode(text) for i in x] == library.encode(text, add_bos=True, add_eos=True)


def test_pieces_take_no_rows_and_no_other_model(no_docs, tmp_path):
    assert pieces.encode(no_docs, MODEL).count() == 0
    model = pieces.sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.read_model(str(tmp_path / "other.model"))


# ---- audit -----------------------------------------------------------------------------------------------------------


def audit_by_hand(rows, labels):
    """{(part, order, step): counts} for rows (doc_id, text, source) of the filters A to E."""
    one = {}
    for d, t, s in rows:
        if d is not None:
            t, s = t or "", s or ""
            one[d] = min(one.get(d, (b"\xff" * 33,)), (hashlib.sha256(t.encode()).digest(), s, t))
    fails = {}
    for d, (_, _, t) in one.items():
        w = WORD.findall(t)
        bad = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        bad["E"] = any(o < d and x[2] == t for o, x in one.items())
        fails[d] = {f for f, x in bad.items() if x}
    good, toxic = ({d for d, *x in labels if x[k] == 1} for k in (0, 1))
    out = {}
    for part in {s for _, s, _ in one.values()}:
        own = [d for d in one if one[d][1] == part]
        here = {}
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                alive = [d for d in own if not fails[d] & set(order[: step - 1])]
                gone = [d for d in alive if f in fails[d]]
                here["".join(order), step] = (
                    len(alive) - len(gone),
                    len(gone),
                    sum(f in fails[d] for d in own) - len(gone),
                    sum(fails[d] == {f} for d in own),
                    len(good.intersection(gone)),
                    len(toxic.intersection(gone)),
                )
        for (order, step), x in here.items():
            out[part, order, step] = (*x, sum(v[1] for (o, s), v in here.items() if o[s - 1] == order[step - 1]))
    return out


def _audited(df, labels):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(df, labels).collect()}


def test_audit_equals_brute_force(spark, odd_docs):
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "BIG", "de$ta", "eps", "zéta"] + [f"w{k}" for k in range(90)]
    rows = [(k % 130 if k % 40 else None, " ".join(rnd.choices(words, k=rnd.choice([3, 49, 50, 60, 200]))), rnd.choice(["s", "t", "", None])) for k in range(150)]
    rows += [(200 + k, rows[1][1], "s") for k in range(60)] + [(300, None, None), (301, "", "u"), (302, "  ", "u"), (7, "other text", "t")]
    labels = [(d, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for d in range(210)] + [(3, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, source string, filter string, prefix int").repartition(5)
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert _audited(df, marked) == audit_by_hand(rows, labels)


def test_audit_takes_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    odd = odd_docs.withColumnRenamed("label", "source")
    assert _audited(odd, none) == audit_by_hand([(r.doc_id, r.text, r.source) for r in odd.collect()], [])
    assert _audited(no_docs.withColumnRenamed("lang", "source"), none) == {}


def test_audit_broadcasts_nothing_that_grows_with_the_documents(spark, monkeypatch):
    """Ids pack well and exploded rows look small in files, so the optimizer would send them all through the driver."""
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    real = filter_audit.staged
    monkeypatch.setattr(filter_audit, "staged", lambda df, what, by=None: plans.append(plan(df)) or real(df, what, by))
    df = spark.createDataFrame([(k, f"short # text {k % 3}", "s") for k in range(9)], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    plans.append(plan(filter_audit.audit(df, labels)))
    assert len(plans) == 4
    assert not [p for p in plans if "Broadcast" in p]


def test_words_of_a_long_text_in_slices(monkeypatch):
    raw = b" ab cd\tab \x0bef " * 50 + b"y" * 40
    want = (len(raw.split()), len(set(raw.split())))
    for size in (1, 3, 7, 1000):
        monkeypatch.setattr(filter_audit, "SLICE_BYTES", size)
        assert filter_audit._words(raw) == want


# ---- repair ----------------------------------------------------------------------------------------------------------


def cheapest(rows):
    """(cost, audit, lines) over all edit sequences with at most two inserts at a place; rows (fault, role, text)."""
    found = []

    def go(k, roles, cost, audit, lines, inserted):
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit, lines))
        if inserted < 2:
            for role in ("user", "assistant"):
                go(k, roles + role[0], cost + 3, audit + "I", [*lines, f"{role}:"], inserted + 1)
        if k < len(rows):
            fault, role, text = rows[k]
            go(k + 1, roles, cost + 4, audit + "D", lines, 0)
            if fault in ("", "truncated"):
                late = 3 * (fault == "truncated")
                if role[:1]:
                    go(k + 1, roles + role[0], cost + late, audit + "K", [*lines, f"{role}:{text}"], 0)
                for other in ("user", "assistant"):
                    go(k + 1, roles + other[0], cost + 3 + late, audit + "R", [*lines, f"{other}:{text}"], 0)

    go(0, "", 0, "", [], 0)
    return min(found)


def judged(rows):
    """(fault, role, text) of rows (turn, role, text) in their order, and the other counts."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "", hashlib.sha256(f"{len(r[1] or '')}:{r[1] or ''}{r[2] or ''}".encode()).digest())
    out, seen = [], set()
    for _, role, text in sorted(rows, key=key):
        role, text = role or "", text or ""
        bare = text.strip("\t\n\x0b\x0c\r ")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((fault, role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(out, out[1:])]
    faults = [f for f, _, _ in out]
    return out, (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs))


def _random_talk(rnd, conv):
    n = rnd.randint(0, 4)
    return [
        (conv, rnd.choice([None, 0, 1, 1, 2, 3, 5, 9]), rnd.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), rnd.choice(["Yes.", "Yes.", "No!", "cut", "", " \t\n", None, "ok?  \n"]))
        for _ in range(n)
    ]


def test_repair_equals_brute_force(spark):
    rnd = random.Random(8)
    talk = {c: _random_talk(rnd, c) for c in [None, *range(70)]}
    rows = [(*r, "x", 0) for t in talk.values() for r in t]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, digest string, header int").repartition(4)
    got = {r.conv_id: r for r in conv_repair.repair(df).collect()}
    assert got.keys() == {c for c, t in talk.items() if t}
    for conv, r in got.items():
        own, counts = judged([x[1:] for x in talk[conv]])
        cost, audit, lines = cheapest(own)
        assert tuple(r)[1:] == (*counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), (conv, own)
    written = conv_repair.apply(df, conv_repair.plan(df).select("conv_id", "audit")).collect()
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in written if r.conv_id == c)) for c in got)


def test_blocks_do_not_change_a_repair(monkeypatch):
    rnd = random.Random(4)
    for _ in range(150):
        rows = [(rnd.choice(["", "", "truncated", "blank", "duplicate"]), rnd.choice("suuaat")) for _ in range(rnd.randint(0, 30))]
        found = []
        for size in (1000, 1, 2, 7):
            monkeypatch.setattr(conv_repair, "BLOCK_ROWS", size)
            own = conv_repair.Repair()
            for r in rows:
                own.add(*r)
            found.append(own.result())
        assert len(set(found)) == 1, rows


def test_lightest_takes_both_antecedents():
    join = lambda a, b: (a[0] + b[0] + 1, a[1] + b[1])
    rules = [(("a", "b"), "ab", join), (("ab", "c"), "goal", join), (("a", "bc"), "goal", join), (("b", "c"), "bc", lambda a, b: (9, "z")), (("x",), "goal", lambda a: (0, ""))]
    final = conv_repair.lightest([("a", (1, "a")), ("b", (1, "b")), ("c", (1, "c"))], rules, "goal")
    assert final["goal"] == (5, "abc") and "x" not in final


def test_a_conversation_of_many_rows_and_an_empty_table(spark):
    many = spark.range(20_000).selectExpr("1L as conv_id", "id as turn", "if(id % 3 = 0, 'assistant', 'user') as role", "if(id % 5 = 0, 'same.', concat('t', id, '.')) as text")
    (r,) = conv_repair.repair(many.repartition(7)).collect()
    own, counts = judged([tuple(x)[1:] for x in many.collect()])
    assert tuple(r)[1:6] == counts and r.audit.count("D") >= counts[2] and len(r.audit.replace("I", "")) == 20_000
    assert conv_repair.repair(many.limit(0)).collect() == []
    (r,) = conv_repair.repair(many.limit(0), many.select("conv_id").distinct()).collect()
    assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_damage_follows_its_rule(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in (1, 2, None) for t in [None, *range(40)]] + [(5, 1, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    assert sorted(map(str, map(tuple, conv_repair.damage(df).collect()))) == sorted(map(str, want))

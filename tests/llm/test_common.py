import random

import numpy as np
import pyarrow as pa

from reportloom.llm import common as C

from .brute import WORD, shingle_set

TEXTS = ["", None, "one", "A b c d e", "a  b\n c\td e f", "\x0bx\x0c", "ü 漢 " * 5, "a b c d e a b c d e a b c d e", "x" * 300]


def test_words_are_those_of_the_pattern():
    data, at = C.flat(pa.array(TEXTS))
    _, row, begin, end = C.words(data, at)
    got = [[] for _ in TEXTS]
    for r, b, e in zip(row, begin, end):
        got[r].append(bytes(data[b:e]).decode())
    assert got == [WORD.findall(t or "") for t in TEXTS]


def test_shingle_counts_and_equality():
    data, at = C.flat(pa.array(TEXTS))
    h, row, _, _ = C.words(data, at)
    sh, ends = C.shingles(h, row, len(TEXTS))
    assert np.diff(ends).tolist() == [len(shingle_set(t)) for t in TEXTS]
    # the same words elsewhere give the same hashes
    data, at = C.flat(pa.array(["zz " * 7, *TEXTS]).slice(1))
    h, row, _, _ = C.words(data, at)
    assert (C.shingles(h, row, len(TEXTS))[0] == sh).all()


def test_chunks_cover_all_rows():
    at = np.array([0, 5, 5, 100, 101, 102, 200])
    assert [*C.chunks(at, 10)] == [(0, 2), (2, 3), (3, 5), (5, 6)]


def test_components_of_chains_stars_and_cycles(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = C.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.label for r in got.collect()} == {x: root(x) for x in up}
    assert C.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0

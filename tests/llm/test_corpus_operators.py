"""Near duplicates, repeated strings, decontamination, neighbours, classifiers."""

import math
import random
import zlib

import numpy as np
import pytest

from reportloom.llm import ann, decontam, near_dup, quality, suffix_dedup, toxicity

from .brute import contained, cut, near

VOCAB = [f"w{i}" for i in range(3000)]


def changed(words, n, rnd):
    out = list(words)
    for k in rnd.sample(range(len(out)), n):
        out[k] = rnd.choice(VOCAB)
    return out


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies of one base, chains of small changes, texts that share half, exact copies."""
    rnd = random.Random(8)
    rows = []
    for base_len in (60, 150):
        base = [rnd.choice(VOCAB) for _ in range(base_len)]
        rows += [changed(base, rnd.choice([0, 1, 1, 2, 3, 5]), rnd) for _ in range(60)]
        chain = base
        for _ in range(12):
            chain = changed(chain, 1, rnd)
            rows.append(chain)
        rows += [base[: base_len // 2] + [rnd.choice(VOCAB) for _ in range(base_len // 2)] for _ in range(20)]
    rows += [[rnd.choice(VOCAB) for _ in range(rnd.choice([0, 1, 3, 4, 5, 40]))] for _ in range(60)]
    rows += [rows[k] for k in range(0, 200, 3)]
    rnd.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, copies, percent):
    got = near_dup.near_duplicates(spark.createDataFrame(copies, "doc_id bigint, text string").repartition(4), percent)
    seen = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
    assert seen == near(copies, percent)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = near_dup.near_duplicates(odd_docs).collect()
    rows = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    want = near(rows.items(), 85)
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in odd_docs.collect() if r.doc_id is not None)
    assert all((r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id) for r in got)
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_parity_maps_never_differ_more_than_their_sets():
    rnd = np.random.default_rng(2)
    sets = [np.sort(rnd.choice(1 << 40, rnd.integers(0, 900), replace=False)).astype(np.uint64) for _ in range(40)]
    sets += [np.union1d(x[::2], y[:5]) for x, y in zip(sets, sets[1:])]
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    maps = near_dup.parity_map(np.concatenate(sets), rows, len(sets))
    apart = lambda a, b: sum(int(x).bit_count() for x in maps[a] ^ maps[b])
    for a in range(len(sets)):
        for b in range(a):
            differ = len(np.setxor1d(sets[a], sets[b]))
            assert apart(a, b) <= differ and (differ > 100 or apart(a, b) >= differ * 0.7)


def test_near_misses_of_a_large_group_leave_inside_the_join(spark, monkeypatch):
    """Copies with three own words each are close to 80 % and mostly below: confirmed pairs stay near the number of members."""
    tested = []
    confirm = near_dup.confirm
    monkeypatch.setattr(near_dup, "confirm", lambda edges, *a: tested.append(edges.count()) or confirm(edges, *a))
    counts = {}
    for size in (150, 300):
        rnd = random.Random(size)
        base = [rnd.choice(VOCAB) for _ in range(120)]
        rows = [(i, " ".join(changed(base, 3, rnd))) for i in range(size)]
        tested.clear()
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 80)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == near(rows, 80)
        counts[size] = sum(tested[1:])  # the rounds after the first pivot
    assert counts[300] <= 300


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_classes_of_any_size_reach_their_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(near_dup, "HOT_CLASSES", hot)
    rows = [(i, "the same text in a third of all rows of it" if i % 3 == 0 else f"text number {i % 11} of several that are told often {i % 11}" if i % 3 == 1 else "") for i in range(60)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), 85)
    assert sorted((r.doc_id, (r.n_shingles, r.component_id)) for r in got.collect()) == sorted(near(rows, 85).items())


@pytest.mark.parametrize("alphabet,depth", [(1, 20), (2, 40), (3, 33), (26, 8), (256, 100)])
def test_suffix_array(alphabet, depth):
    rnd = np.random.default_rng(alphabet)
    text = rnd.integers(0, alphabet, 2500).astype(np.uint8)
    text[1500:1900] = text[100:500]
    order = suffix_dedup.suffix_array(text, depth)
    raw = text.tobytes()
    keys = [raw[i : i + depth] for i in order]
    assert sorted(order.tolist()) == list(range(2500)) and all(a <= b for a, b in zip(keys, keys[1:]))


@pytest.mark.parametrize("length,hot", [(100, 4096), (40, 4096), (40, 0)])
def test_repeated_strings(spark, docs, odd_docs, length, hot):
    rnd = random.Random(length)
    passage = " ".join(rnd.choice(VOCAB) for _ in range(60))
    own = [(i, " ".join(rnd.choice(VOCAB) for _ in range(rnd.randrange(40))) + (passage[rnd.randrange(50) :] if i % 3 else "") + "z" * (i * 3)) for i in range(80)]
    for rows in (own, [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None]):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        want = sorted((rows[k][0], *v) for k, v in cut(rows, length).items())
        got = suffix_dedup.dedup(df, length, keep_text=True, hot_passages=hot).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [w[:5] for w in want]
        assert sorted(r.kept_text for r in got) == sorted(w[5].decode("utf-8", "ignore") for w in want)


def test_repeated_strings_of_the_documents(docs, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = {rows[k][0]: v[:4] for k, v in cut(rows, 100).items()}
    assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup(docs).collect()} == want
    assert suffix_dedup.dedup(odd_docs).count() == 12
    assert suffix_dedup.dedup(no_docs).count() == 0


def test_containment(spark, odd_docs, no_docs):
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choice(VOCAB) for _ in range(rnd.choice([3, 8, 16, 50])))) for i in range(40)] + [(90, None), (91, ""), (92, "one two three")]
    docs = []
    for d in range(120):
        w = [rnd.choice(VOCAB) for _ in range(rnd.choice([0, 30, 300, 4000]))]
        for _, text in rnd.sample(items[:40], 2):
            part = text.split()
            if rnd.random() < 0.4:
                part = changed(part, 1, rnd)
            at = rnd.randrange(len(w) + 1)
            w[at:at] = part
        docs.append((d, " ".join(w)))
    columns = "c int, h int, sh int, n_shared int"
    one = spark.createDataFrame([(*r, 1, 1, 1, 1) for r in docs], f"doc_id bigint, text string, {columns}")
    two = spark.createDataFrame([(*r, 1, 1, 1, 1) for r in items] * 2, f"item_id bigint, text string, {columns}")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in decontam.contained_items(one, two).collect()}
    assert got == contained(docs, items)
    found = {(r.doc_id, r.item_id) for r in decontam.contained_items(odd_docs, two).collect()}
    assert found == {(6, 92), (7, 92)}
    assert decontam.contained_items(no_docs, two).count() == 0
    assert decontam.contained_items(one, two.limit(0)).count() == 0
    assert "Python" not in decontam.contained_items(one, two)._jdf.queryExecution().toString()


def test_a_long_item_and_repeated_items(spark):
    long = " ".join(f"w{k % 700}x{k}" for k in range(2000))
    items = spark.createDataFrame([(1, long), (2, "z y x w v u t"), (2, "a b c d e f g h"), (3, None), (3, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before {long} after"), (2, "a b c d e f g h"), (3, "z y x w v u t"), (4, "one two three four five six")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_shingles for r in decontam.contained_items(docs, items).collect()}
    # of the rows of one item the least text is taken, an empty one before others
    assert got == {(1, 1): 1996, (2, 2): 4}


def test_items_are_hashed_once(spark, monkeypatch):
    """No filter pulls the hashing of an item into itself: it stands in the plan that is stored, and in no other."""
    plans = []
    staged = decontam.staged
    monkeypatch.setattr(decontam, "staged", lambda df, what: plans.append((what, df._jdf.queryExecution().optimizedPlan().toString())) or staged(df, what))
    items = spark.createDataFrame([(1, "a b c d e f g h"), (2, " ".join(f"w{k}" for k in range(60)))], "item_id long, text string")
    decontam.contained_items(items.withColumnRenamed("item_id", "doc_id"), items).collect()
    (stored,) = [p for what, p in plans if what == "items"]
    assert stored.count("xxhash64") >= 2
    for what, plan in plans:
        assert not any("xxhash64" in line for line in plan.splitlines() if "Filter" in line and "item_id" in line), what


@pytest.mark.parametrize("broadcast_rows", [decontam.BROADCAST_ROWS, 200, 0])
def test_short_items_in_long_documents(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", broadcast_rows)
    rnd = random.Random(5)
    # of 5 to 10 words, and some that meet sketches
    sizes = [3] * 2 + [5, 6, 7, 8, 9, 10] * 8 + [15, 60] * 2
    items = [(i, " ".join(f"i{i}w{k}" for k in range(n))) for i, n in enumerate(sizes)]
    docs = []
    for d in range(27):
        w = [rnd.choice(VOCAB) + str(rnd.randrange(10**6)) for _ in range(rnd.choice([1000, 2500, 4000]))]
        at = rnd.randrange(len(w))
        docs.append((d, " ".join([*w[:at], items[2 * d][1], *w[at:], items[2 * d + 1][1]])))
    one, two = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in decontam.contained_items(one, two).collect()}
    want = contained(docs, items)
    # three words are a shingle of their own, which no longer document has
    assert len(want) == len(items) - 2
    assert got == want


def brute_nearest(rows, q, k):
    found = sorted(((-float(np.dot(np.array(v, float), np.array(q[1], float))), i) for i, v in rows if i != q[0]))[:k]
    return [(i, -s) for s, i in found]


@pytest.mark.parametrize("tree, batch", [(ann.TREE, ann.BATCH), (400, 20)])
def test_neighbours(spark, monkeypatch, tree, batch):
    """In one tree and one batch, and in five trees and five batches."""
    monkeypatch.setattr(ann, "TREE", tree)
    monkeypatch.setattr(ann, "BATCH", batch)
    rnd = np.random.default_rng(6)
    centres = rnd.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rnd.normal(size=16) * 0.6).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[5][1]) for i in range(300)]
    odd = [(5000, None), (5001, [0.0] * 16), (5002, [math.nan] + [1.0] * 15), (5003, [math.inf] * 16), (5004, [1.0, None] + [1.0] * 14), (5005, [1.0]), (5006, [])]
    df = spark.createDataFrame([(*r, 0, 0.0) for r in rows + odd + rows[:3]], "vec_id bigint, embedding array<float>, rank int, score double")
    got = {}
    for r in ann.neighbours(df, df.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    asked = [r for r in rows if r[0] % 20 == 0]
    assert sorted(got) == [r[0] for r in asked]
    hit = 0
    for q in asked:
        own, want = got[q[0]], brute_nearest(rows, q, 20)
        assert [x[0] for x in own] == list(range(1, 21)) and all(math.isclose(s, float(np.dot(dict(rows)[i], q[1])), rel_tol=1e-9) for _, i, s in own)
        assert own == sorted(own, key=lambda x: (-x[2], x[1]))
        hit += len({i for _, i, _ in own} & {i for i, _ in want})
    assert hit >= 0.9 * 20 * len(asked)


def test_neighbours_of_few_and_of_none(spark):
    few = spark.createDataFrame([(20, [1.0, 0.0]), (40, [1.0, 1.0]), (7, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    got = [tuple(r) for r in ann.neighbours(few, few.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 40, 1.0), (20, 2, 7, 0.0), (40, 1, 7, 1.0), (40, 2, 20, 1.0)]
    assert ann.neighbours(few.limit(0), few.limit(0)).count() == 0


def test_chi_square():
    assert ann.chi_square(np.array([0.0, 7.344, 15.507, 20.090]), 8).round(3).tolist() == [0, 0.5, 0.95, 0.99]
    assert math.isclose(ann.chi_square_quantile(0.95, 8), 15.507, abs_tol=1e-3) and math.isclose(ann.chi_square_quantile(0.95, 24), 36.415, abs_tol=1e-3)


def test_search_stops():
    """On clusters a small part of the vectors is verified; without a stop (an endless limit) the search is exact."""
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(50, 64))
    x = centres[np.arange(10_000) % 50] + 0.35 * rnd.normal(size=(10_000, 64))
    lift = float((x * x).sum(axis=1).max())
    matrix = rnd.standard_normal((65, ann.DIMS))
    tree = ann.Tree(np.arange(len(x)), x, matrix, lift)
    seen = hit = 0
    for i in range(0, len(x), 200):
        scores = x @ x[i]
        scores[i] = -math.inf
        want = np.lexsort((np.arange(len(x)), -scores))[:20]
        ids, _, verified = tree.search(x[i], x[i] @ matrix[:-1], lift, 20, i, ann.chi_square_quantile(0.95))
        hit, seen = hit + len(np.intersect1d(ids, want)), seen + verified
        ids, got, verified = tree.search(x[i], x[i] @ matrix[:-1], lift, 20, i, math.inf)
        assert ids.tolist() == want.tolist() and np.allclose(got, scores[want]) and verified == len(x) - 1
    assert hit >= 0.95 * 20 * 50 and seen <= 0.2 * 50 * len(x)


def test_an_id_with_two_vectors(spark):
    """It is found by each of its vectors and asks with the smaller one."""
    df = spark.createDataFrame([(20, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [5.0, 0.0]), (3, [0.0, 4.0])], "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in ann.neighbours(df, df.filter("vec_id = 20")).orderBy("rank").collect()]
    assert got == [(20, 1, 3, 4.0), (20, 2, 3, 0.0)]


def auc(y, s):
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize("module,label,folds,fold,cut_at,least", [(quality, "quality", 5, 0, 0.3, 0.95), (toxicity, "toxic", 3, 1, 0.7, 0.75)])
def test_classifiers(spark, odd_docs, no_docs, module, label, folds, fold, cut_at, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = module.score(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = np.array([zlib.crc32(str(d).encode()) % folds == fold for d in rows.doc_id])
    assert (held == rows.held_out).all() and ((rows.score >= cut_at) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    assert auc(rows[label][held].to_numpy(), rows.score[held].to_numpy()) >= least
    odd = module.score(odd_docs, labels).collect()
    assert len(odd) == 13 and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in module.score(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert module.score(no_docs, labels).count() == 0


def test_toxicity_learns_a_pair():
    """An insult counts only together with a mention; linear weights alone cannot say so."""
    rnd = np.random.default_rng(1)
    insult, mention = rnd.random(4000) < 0.5, rnd.random(4000) < 0.5
    y = (insult == mention).astype(float) * 0.0 + (insult & mention)
    bins = np.concatenate((np.full(insult.sum(), 10), np.full(mention.sum(), 20)))
    row = np.concatenate((np.flatnonzero(insult), np.flatnonzero(mention)))
    m = toxicity.train(bins, row, y)
    z = m.raw(np.array([10, 10, 20, 20]), np.array([0, 1, 1, 2]), 4)
    assert z[1] > 0 > max(z[0], z[2], z[3]) and (m.v[0] * m.v[1]).sum() > 0


def test_forward_backward_equals_enumeration():
    rnd = np.random.default_rng(3)
    z, move, row = rnd.normal(size=(7, 2)), rnd.normal(size=(2, 2)), np.array([0, 0, 0, 0, 1, 2, 2])
    good, moves, total = quality.marginals(z, move, quality.Layout(row, 3))
    want, pairs, logs = np.zeros(7), np.zeros((2, 2)), 0
    for d in range(3):
        at = np.flatnonzero(row == d)
        weights = {}
        for code in range(2 ** len(at)):
            lab = [(code >> k) & 1 for k in range(len(at))]
            weights[tuple(lab)] = math.exp(sum(z[i, v] for i, v in zip(at, lab)) + sum(move[a, b] for a, b in zip(lab, lab[1:])))
        norm = sum(weights.values())
        logs += math.log(norm)
        for lab, w in weights.items():
            for i, v in zip(at, lab):
                want[i] += v * w / norm
            for a, b in zip(lab, lab[1:]):
                pairs[a, b] += w / norm
    assert np.allclose(good, want) and np.allclose(moves, pairs) and math.isclose(total, logs)

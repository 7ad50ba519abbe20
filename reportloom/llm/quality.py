"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, flat, parts, words
from .labelled import remainder, training_rows

#: Bound of the training sample: labelled documents, and bytes of one.
TRAIN_ROWS, TRAIN_BYTES = 6_000, 1 << 16
_CLASSES = {
    "upper": range(65, 91),
    "letter": [*range(65, 91), *range(97, 123), *range(128, 256)],
    "digit": range(48, 58),
    "bang": [33, 63],
    "bar": [124],
    "sign": [35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 94, 95, 126],
    "stop": [44, 46, 58, 59],
}
_KINDS = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}
N_OWN = 12
#: Own features of a line, those of the line before and after, and a constant.
N_FEATURES = 3 * N_OWN + 1


def line_features(data: np.ndarray, at: np.ndarray):
    """Features of each line, its document row and its length; each document has a line at least."""
    n = len(at) - 1
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(at, breaks, "right") - 1
    begin = np.sort(np.concatenate((at[:-1], breaks + 1)))
    row = np.sort(np.concatenate((np.arange(n), owner)))
    end = np.empty(len(begin), np.int64)
    end[:-1] = begin[1:]
    end[-1] = len(data) if len(begin) else 0
    last = np.ones(len(begin), bool)
    last[:-1] = row[1:] != row[:-1]
    end = np.where(last, at[row + 1], end - 1)
    size = end - begin
    count = {}
    for k, inside in _KINDS.items():
        sums = np.concatenate(([0], np.cumsum(inside[data])))
        count[k] = (sums[end] - sums[begin]).astype(float)
    # a line break is white space, so no word reaches over it
    h, _, where, _ = words(data, at)
    line = np.searchsorted(begin, where, "right") - 1
    # empty lines share their begin with nothing that has words; the last of equal begins is the one with text
    n_words = np.bincount(line, minlength=len(begin)).astype(float)
    again = np.zeros(len(begin))
    unique = np.zeros(len(begin))
    if len(h):
        twice = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
        again += np.bincount(line[1:][twice], minlength=len(begin))
        order = np.lexsort((h, line))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (line[order][1:] != line[order][:-1])
        unique += np.bincount(line[order][new], minlength=len(begin))
    w, c = np.maximum(n_words, 1), np.maximum(size, 1)
    own = np.stack(
        [
            np.log1p(n_words),
            count["upper"] / np.maximum(count["letter"], 1),
            count["letter"] / c,
            count["digit"] / c,
            count["bang"] / w,
            count["bar"] / w,
            count["sign"] / w,
            count["stop"] / w,
            again / w,
            np.where(n_words > 0, unique / w, 1),
            np.minimum(np.log1p(size / w), 5),
            (n_words == 0).astype(float),
        ],
        1,
    )
    own = np.minimum(own, 5)
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = row[1:] == row[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return np.hstack((own, before, after, np.ones((len(own), 1)))), row, size


class Layout:
    """Lines of many documents, position by position: documents by falling number of lines, so that a step is a slice."""

    def __init__(self, row: np.ndarray, n: int):
        lines = np.bincount(row, minlength=n)
        self.docs = np.argsort(-lines, kind="stable")
        first = np.concatenate(([0], np.cumsum(lines)))[:-1][self.docs]
        alive = np.searchsorted(-lines[self.docs], -np.arange(lines.max(initial=0)), "left")
        self.steps = [first[:k] + t for t, k in enumerate(alive)]


def marginals(z: np.ndarray, move: np.ndarray, layout: Layout):
    """Forward-backward over two labels: P(good) of each line, expected moves, and the summed log partition.

    ``z``: (lines, 2) log potentials. ``move``: (2, 2) log potentials of label pairs.
    """
    f, b = np.zeros_like(z), np.zeros_like(z)
    for t, at in enumerate(layout.steps):
        if t == 0:
            f[at] = z[at]
        else:
            before = f[layout.steps[t - 1][: len(at)]]
            f[at] = z[at] + np.logaddexp(before[:, :1] + move[0], before[:, 1:] + move[1])
    moves = np.zeros((2, 2))
    total = 0.0
    for t in range(len(layout.steps) - 1, -1, -1):
        at = layout.steps[t]
        n_next = len(layout.steps[t + 1]) if t + 1 < len(layout.steps) else 0
        if n_next:
            nxt = layout.steps[t + 1]
            ahead = z[nxt] + b[nxt]
            own = at[:n_next]
            b[own] = np.stack([np.logaddexp(move[k, 0] + ahead[:, 0], move[k, 1] + ahead[:, 1]) for k in (0, 1)], 1)
            part = np.logaddexp(f[own, 0] + b[own, 0], f[own, 1] + b[own, 1])
            for k in (0, 1):
                for m in (0, 1):
                    moves[k, m] += np.exp(f[own, k] + move[k, m] + ahead[:, m] - part).sum()
        if t == 0:
            total = np.logaddexp(f[at, 0] + b[at, 0], f[at, 1] + b[at, 1]).sum()
    good = 1 / (1 + np.exp(np.clip(f[:, 0] + b[:, 0] - f[:, 1] - b[:, 1], -50, 50)))
    return good, moves, total


class Field:
    """Weights of the field, the features' scale, and the two numbers that turn a weighted share into a score."""

    def __init__(self):
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.w, self.move = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
        self.a, self.b = 1.0, 0.0

    def share(self, x: np.ndarray, row: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
        """Length-weighted mean of P(good); a document without bytes counts its empty line once."""
        if not n:
            return np.zeros(0)
        good, _, _ = marginals(((x - self.mean) / self.scale) @ self.w, self.move, Layout(row, n))
        weight = size + 1e-3
        return np.bincount(row, weights=good * weight, minlength=n) / np.bincount(row, weights=weight, minlength=n)

    def score(self, share: np.ndarray) -> np.ndarray:
        x = np.clip(share, 1e-4, 1 - 1e-4)
        return 1 / (1 + np.exp(-np.clip(self.a * np.log(x / (1 - x)) + self.b, -30, 30)))


def train(x: np.ndarray, row: np.ndarray, size: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, l2: float = 1e-4) -> Field:
    """Conditional likelihood by Adam; every line has its document's label, rarer labels weigh more."""
    own = Field()
    own.mean, own.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    own.mean[-1], own.scale[-1] = 0, 1
    x = (x - own.mean) / own.scale
    n, layout, label = len(y), Layout(row, len(y)), y[row].astype(int)
    truth = np.zeros((2, 2))
    follow = row[1:] == row[:-1]
    np.add.at(truth, (label[:-1][follow], label[1:][follow]), 1)
    target = np.stack((label == 0, label == 1), 1).astype(float)
    par = [own.w, own.move]
    one, two = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    for t in range(1, rounds + 1):
        good, moves, _ = marginals(x @ par[0], par[1], layout)
        expected = np.stack((1 - good, good), 1)
        grads = [x.T @ (expected - target) / n + l2 * par[0], (moves - truth) / n + l2 * par[1]]
        for k in range(2):
            one[k] = 0.9 * one[k] + 0.1 * grads[k]
            two[k] = 0.999 * two[k] + 0.001 * grads[k] ** 2
            par[k] = par[k] - rate * (one[k] / (1 - 0.9**t)) / (np.sqrt(two[k] / (1 - 0.999**t)) + 1e-8)
    own.w, own.move = par
    share = np.clip(own.share(x * own.scale + own.mean, row, size, n), 1e-4, 1 - 1e-4)
    logit = np.log(share / (1 - share))
    a, b = 1.0, 0.0
    for _ in range(300):
        g = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30))) - y
        a, b = max(0.05, a - 0.1 * (g * logit).mean()), b - 0.3 * g.mean()
    own.a, own.b = a, b
    return own


def fitted(docs: DataFrame, labels: DataFrame, folds: int, fold: int, id_col: str, text_col: str) -> Field:
    """A field trained on up to ``TRAIN_ROWS`` labelled documents outside ``fold``, of up to ``TRAIN_BYTES`` bytes each."""
    sample = training_rows(docs, labels, "quality", remainder(id_col, folds) != fold, TRAIN_ROWS, TRAIN_BYTES, id_col, text_col)

    def features(batches):
        for batch in parts(batches):
            data, at = flat(batch.column(0))
            y = batch.column(1).to_pylist()
            for i, j in chunks(at):
                x, row, size = line_features(data[at[i] : at[j]], at[i : j + 1] - at[i])
                cut_at = np.searchsorted(row, np.arange(j - i + 1))
                some = [(x[a:b].astype(np.float32).tobytes(), size[a:b].tobytes()) for a, b in zip(cut_at[:-1], cut_at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v[0] for v in some], pa.binary()), pa.array([v[1] for v in some], pa.binary()), pa.array(y[i:j], pa.int32())], ["x", "size", "y"]
                )

    rows = sample.select(text_col, "quality").mapInArrow(features, "x binary, size binary, y int").collect()
    if not rows:
        return Field()
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(v) for v in x])
    size = np.concatenate([np.frombuffer(r["size"], np.int64) for r in rows])
    return train(np.concatenate(x).astype(float), row, size, np.array([r["y"] for r in rows], float))


def with_score(docs: DataFrame, field: Field, name: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and the score of the whole text as ``name``; nothing is shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(field)  # a few hundred numbers
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in parts(batches):
            data, at = flat(batch.column(place))
            for i, j in chunks(at):
                x, row, size = line_features(data[at[i] : at[j]], at[i : j + 1] - at[i])
                got = model.value.score(model.value.share(x, row, size, j - i))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got)], [*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score (0 to 1, higher: likelier good), predicted (score >= ``cut``).

    A conditional random field labels the lines of a text good or bad from their own features and those of the lines
    beside them; forward-backward marginals, weighted by line length, make the document's share of good text, and a
    logistic curve makes that a score. Trained on up to ``TRAIN_ROWS`` labelled documents of up to ``TRAIN_BYTES`` bytes
    whose crc32(id as text) modulo ``folds`` is not ``fold``; every whole text is scored. A null or empty text is one
    empty line; a row without id is scored and not held out. Without training rows all scores are 0.5. Repeated rows are
    scored each; other columns are not read; an empty table gives an empty result.
    """
    field = fitted(docs, labels, folds, fold, id_col, text_col)
    held = F.coalesce(remainder(id_col, folds) == fold, F.lit(False))
    return with_score(docs.select(id_col, text_col), field, "score", text_col).select(
        id_col, held.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``cut`` or more, with all their columns."""
    name = "score__"
    while name in docs.columns:
        name += "_"
    return with_score(docs, fitted(docs, labels, folds, fold, id_col, text_col), name, text_col).filter(F.col(name) >= cut).drop(name)

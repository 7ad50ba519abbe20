"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, mix, parts, prefix_hash, span_hash, words
from .labelled import remainder, training_rows

#: Bits of the hashed term space, latent dimensions, and the length of word beginnings that are terms too.
BITS, FACTORS, STEM = 20, 4, 5
#: Bound of the training sample: labelled documents, and bytes of one.
TRAIN_ROWS, TRAIN_BYTES = 12_000, 1 << 16
#: Terms that the labels tell apart at least this well (log-likelihood ratio) enter the machine.
SCREEN = 18.0

_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


def terms(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed bins of words and of word beginnings, and their rows; ``data`` is lower case."""
    h, row, begin, end = words(data, at, lower=False, inside=_INSIDE)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    long = end - begin > STEM
    stems = span_hash(prefix_hash(data), begin[long], begin[long] + STEM)
    both = np.concatenate((h, mix(stems + np.uint64(5))))
    return (both >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate((row, row[long]))


def lowered(column):
    return pc.utf8_lower(pc.fill_null(column, ""))


class Machine:
    """w0 + sum of w_i x_i + sum over pairs of <v_i, v_j> x_i x_j, x_i being whether term i occurs."""

    def __init__(self, bins: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[bins] = np.arange(len(bins))
        self.w0, self.w, self.v = w0, w, v

    def raw(self, bins: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.w0)
        own = self.place[bins]
        hit = own >= 0
        if hit.any():
            cell = np.unique(row[hit] * len(self.w) + own[hit])
            r, t = cell // len(self.w), cell % len(self.w)
            out += np.bincount(r, weights=self.w[t], minlength=n)
            for f in range(self.v.shape[1]):
                v = self.v[t, f]
                s = np.bincount(r, weights=v, minlength=n)
                out += 0.5 * (s * s - np.bincount(r, weights=v * v, minlength=n))
        return out


def _informative(bins: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bins whose presence has a log-likelihood ratio of ``SCREEN`` or more with the label; a row has a bin once."""
    a = np.bincount(bins, weights=y[row], minlength=1 << BITS)
    n = np.bincount(bins, minlength=1 << BITS)
    some = np.flatnonzero(n > 0)
    a, n = a[some], n[some]
    pos, total = y.sum(), len(y)

    def part(k, m):
        with np.errstate(divide="ignore", invalid="ignore"):
            p = k / m
            return np.where(k > 0, k * np.log(p), 0) + np.where(m - k > 0, (m - k) * np.log(1 - p), 0)

    rest = part(pos - a, np.maximum(total - n, 1e-9))
    return some[2 * (part(a, n) + rest - part(np.array([pos]), total)) >= SCREEN]


def train(bins: np.ndarray, row: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 0.05, l2: float = 1e-4, seed: int = 3) -> Machine:
    """Full-batch Adam on the logistic loss of the screened terms."""
    chosen = _informative(bins, row, y)
    y = y.astype(np.float32)
    m = Machine(chosen, 0.0, np.zeros(len(chosen)), np.zeros((len(chosen), FACTORS)))
    own = m.place[bins]
    x = np.zeros((len(y), len(chosen)), np.float32)
    x[row[own >= 0], own[own >= 0]] = 1
    # both labels weigh the same in sum, however rare one is
    weight = np.where(y > 0, 0.5 / max(1.0, float(y.sum())), 0.5 / max(1.0, float(len(y) - y.sum()))).astype(np.float32)
    par = [np.array([-1.0], np.float32), np.zeros(len(chosen), np.float32), np.random.default_rng(seed).normal(0, 0.05, (len(chosen), FACTORS)).astype(np.float32)]
    one, two = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    for t in range(1, rounds + 1):
        s = x @ par[2]
        z = par[0] + x @ par[1] + 0.5 * ((s * s).sum(axis=1) - x @ (par[2] ** 2).sum(axis=1))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grads = [np.array([g.sum()], np.float32), x.T @ g + l2 * par[1] * 0.1, x.T @ (g[:, None] * s) - par[2] * (x.T @ g)[:, None] + l2 * par[2]]
        for k in range(3):
            one[k] = 0.9 * one[k] + 0.1 * grads[k]
            two[k] = 0.999 * two[k] + 0.001 * grads[k] ** 2
            par[k] = par[k] - rate * (one[k] / (1 - 0.9**t)) / (np.sqrt(two[k] / (1 - 0.999**t)) + 1e-8)
    m.w0, m.w, m.v = float(par[0][0]), par[1], par[2]
    return m


def score(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, cut: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score (0 to 1, higher: likelier toxic), predicted (score >= ``cut``).

    Trained on up to ``TRAIN_ROWS`` labelled documents of up to ``TRAIN_BYTES`` bytes whose crc32(id as text) modulo
    ``folds`` is not ``fold``; every whole text is scored. Inputs are the text's terms alone: words of letters and digits
    in lower case, and beginnings of words. Null and empty texts have no terms and get the score of the bias; a row without id
    is scored and not held out. Without any training row all scores are 0.5. Repeated rows are scored each; other columns are not read.
    """
    sample = training_rows(docs, labels, "toxic", remainder(id_col, folds) != fold, TRAIN_ROWS, TRAIN_BYTES, id_col, text_col)

    def features(batches):
        for batch in parts(batches):
            data, at = flat(lowered(batch.column(0)))
            y = batch.column(1).to_pylist()
            for i, j in chunks(at):
                bins, row = terms(data[at[i] : at[j]], at[i : j + 1] - at[i])
                cell = np.unique(row * (1 << BITS) + bins)
                cut_at = np.searchsorted(cell >> BITS, np.arange(j - i + 1))
                own = (cell & ((1 << BITS) - 1)).astype(np.int32)
                some = [own[a:b].tobytes() for a, b in zip(cut_at[:-1], cut_at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array(y[i:j], pa.int32())], ["bins", "y"])

    rows = sample.select(text_col, "toxic").mapInArrow(features, "bins binary, y int").collect()
    machine = Machine(np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    if rows:
        own = [np.frombuffer(r["bins"], np.int32) for r in rows]
        y = np.array([r["y"] for r in rows], float)
        del rows
        row = np.repeat(np.arange(len(own), dtype=np.int32), [len(x) for x in own])
        machine = train(np.concatenate(own), row, y)
    model = docs.sparkSession.sparkContext.broadcast(machine)  # 4 MB of places and a few thousand weights
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, score double"

    def run(batches):
        for batch in parts(batches):
            data, at = flat(lowered(batch.column(1)))
            for i, j in chunks(at):
                bins, row = terms(data[at[i] : at[j]], at[i : j + 1] - at[i])
                z = model.value.raw(bins, row, j - i)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], [id_col, "score"])

    return (
        docs.select(id_col, text_col)
        .mapInArrow(run, schema)
        .select(id_col, F.coalesce(remainder(id_col, folds) == fold, F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
    )

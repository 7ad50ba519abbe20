"""Byte-level BPE encoding and decoding over length-bucketed numpy matrices."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import mix, parts

#: Pieces longer than this are merged with a heap: a matrix row costs the square of its length.
MATRIX_MOST = 256
#: Cells of one matrix.
CELLS = 1 << 19
_NONE = np.int32(0x7FFFFFFF)


def read_ranks(path: str, most_bytes: int = 64 << 20) -> bytes:
    """The rank file, read on the driver; refused above ``most_bytes``, the bound of its broadcast."""
    with open(path, "rb") as f:
        blob = f.read(most_bytes + 1)
    if len(blob) > most_bytes:
        raise ValueError(f"{path} is larger than {most_bytes} bytes")
    return blob


class Codec:
    """Ranks, a hashed table of mergeable pairs, and the bytes of every id."""

    def __init__(self, blob: bytes, pattern: str):
        self.find = regex.compile(pattern).findall
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())}
        self.token = {r: t for t, r in self.ranks.items()}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        found = {}
        for t, r in self.ranks.items():
            for k in range(1, len(t)):
                left, right = self.ranks.get(t[:k]), self.ranks.get(t[k:])
                if left is not None and right is not None:
                    found[left << 32 | right] = r
        self.pairs = found
        keys = np.fromiter(found, np.uint64, len(found))
        ranks = np.fromiter(found.values(), np.int32, len(found))
        self.bits = max(4, int(np.ceil(np.log2(len(keys) * 4 + 16))))
        self.key = np.full(1 << self.bits, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.rank = np.full(1 << self.bits, _NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.key[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            self.key[slot[free]] = keys[free]  # of several keys for a slot the last stays
            won = self.key[slot] == keys
            self.rank[slot[won]] = ranks[won]
            keys, ranks, slot = keys[~won], ranks[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)
        self.cache: dict[str, list[int]] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``_NONE``."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        got = self.key[slot]
        out = np.where(got == keys, self.rank[slot], _NONE)
        open_ = np.flatnonzero((got != keys) & (got != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            got = self.key[slot[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.rank[slot[open_[hit]]]
            open_ = open_[~hit & (got != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out

    def merge_matrix(self, pieces: list[bytes]) -> list[list[int]]:
        """Pieces of one length: every round each row merges its leftmost pair of least rank; done rows leave."""
        width = len(pieces[0])
        ids = self.byte[np.frombuffer(b"".join(pieces), np.uint8)].reshape(len(pieces), width)
        out: list = [None] * len(pieces)
        row = np.arange(len(pieces))
        pair = self.look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), -1)
        while len(row):
            at = pair.argmin(axis=1) if pair.shape[1] else np.zeros(len(row), np.int64)
            best = pair[np.arange(len(row)), at] if pair.shape[1] else np.full(len(row), _NONE)
            done = best == _NONE
            if done.any():
                for r, v in zip(row[done].tolist(), ids[done].tolist()):
                    out[r] = v
                keep = ~done
                row, ids, pair, at, best = row[keep], ids[keep], pair[keep], at[keep], best[keep]
                if not len(row):
                    break
            n, w = ids.shape
            every = np.arange(n)
            # compaction: drop the right half of the merged pair from every row
            mask = np.ones((n, w), bool)
            mask[every, at + 1] = False
            ids[every, at] = best
            ids = ids[mask].reshape(n, w - 1)
            mask = np.ones((n, w - 1), bool)
            mask[every, at] = False
            pair = pair[mask].reshape(n, w - 2)
            has = np.flatnonzero(at > 0)
            pair[has, at[has] - 1] = self.look_up(ids[has, at[has] - 1], ids[has, at[has]])
            has = np.flatnonzero(at < w - 2)
            pair[has, at[has]] = self.look_up(ids[has, at[has]], ids[has, at[has] + 1])
        return out

    def merge_heap(self, piece: bytes) -> list[int]:
        """One long piece: same merges in the same order, from a heap over a linked list."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        pairs = self.pairs
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if a >= 0 and b >= 0 and (x := pairs.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (x, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of new pieces into the cache."""
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            raw = p.encode()
            if (r := self.ranks.get(raw)) is not None:
                self.cache[p] = [r]
            elif len(raw) > MATRIX_MOST:
                self.cache[p] = self.merge_heap(raw)
            else:
                by_length.setdefault(len(raw), []).append((p, raw))
        for width, some in by_length.items():
            step = max(1, CELLS // width)
            for k in range(0, len(some), step):
                part = some[k : k + step]
                self.cache.update(zip((p for p, _ in part), self.merge_matrix([raw for _, raw in part])))

    def encode(self, texts: list[str], batch_chars: int = 1 << 20) -> Iterator[np.ndarray]:
        """Ids of each text; pieces of about ``batch_chars`` characters are merged together."""
        k = 0
        while k < len(texts):
            end, size = k, 0
            while end < len(texts) and (end == k or size + len(texts[end]) <= batch_chars):
                size += len(texts[end])
                end += 1
            found = [self.find(t) for t in texts[k:end]]
            if len(self.cache) > 300_000:
                self.cache = {}
            new = set().union(*found) - self.cache.keys()
            if new:
                self.learn(new)
            get = self.cache.__getitem__
            for pieces in found:
                ids: list[int] = []
                for x in map(get, pieces):
                    ids += x
                yield np.array(ids, "<u4")
            k = end

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


_codecs: dict[tuple, Codec] = {}


def codec(blob: bytes, pattern: str) -> Codec:
    """One codec per worker process."""
    key = (hash(blob), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(blob, pattern)
    return _codecs[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode every whole text by the ranks of a tiktoken file, and decode the ids again.

    Returns id_col, ids array<int> (only with ``keep_ids``), n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit
    integers) and decoded_sha256. Null and empty text: no ids, digests of nothing. Repeated rows give repeated results,
    an empty table an empty result; other columns are not read. A projection: no shuffle, a lost task is just run again.
    """
    blob = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    field = docs.schema[id_col]
    schema = f"{id_col} {field.dataType.simpleString()}" + (", ids array<int>" if keep_ids else "") + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        own = codec(blob.value, pattern)
        for batch in parts(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for k in range(0, max(1, len(texts)), 500):
                some = texts[k : k + 500]
                every, n, a, b = [], [], [], []
                for ids in own.encode(some):
                    if keep_ids:
                        every.append(ids.astype(np.int32))
                    n.append(len(ids))
                    a.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    b.append(hashlib.sha256(own.decode(ids)).hexdigest())
                cols = [batch.column(0).slice(k, 500)] + ([pa.array(every, pa.list_(pa.int32()))] if keep_ids else [])
                names = [id_col] + (["ids"] if keep_ids else []) + ["n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)

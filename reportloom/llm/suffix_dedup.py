"""Removal of repeated byte strings with a two-stage suffix array over passages that hold a repeated anchor."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, in_blocks, mix, prefix_hash, span_hash

#: Bytes of an anchor: each repeated string is found by one gram of this size in it.
GRAM = 24
#: About so many bytes of text stand for one bucket of anchors.
BUCKET_BYTES = 4 << 20
#: Bytes of text in a block of documents.
BLOCK_BYTES = 2 << 20
#: Bytes of passages that go into one suffix array; an anchor's passages stay together.
ARRAY_BYTES = 1 << 19
#: An anchor with more different passages than this is decided by window hashes, which are added up before they travel.
HOT = 4096
_STEP = 1 << 19
_ANSWER = "block bigint, bucket bigint, anchors binary, codes binary"
_PASSAGES = "block bigint, bucket bigint, anchors binary, doc binary, start binary, size binary, text binary"
_WINDOWS = "block bigint, bucket bigint, hash binary, doc binary, start binary"
_RUNS = "block bigint, doc binary, start binary, stop binary"


# ---- two-stage suffix array ------------------------------------------------------------------------------------------


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number."""
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8)))
    out = np.zeros(len(text) + depth, np.uint64)
    for k in range(8):
        out |= padded[k : k + len(out)].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def _last(depth: int) -> np.uint64:
    """Mask of the last word when ``depth`` is no multiple of eight."""
    rest = depth % 8 or 8
    return np.uint64((0xFFFFFFFFFFFFFFFF << (64 - 8 * rest)) & 0xFFFFFFFFFFFFFFFF)


def _direct(idx: np.ndarray, w: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by ``depth`` bytes: word by word, and after each word only what is still tied."""
    key = w[idx]
    order = np.argsort(key, kind="stable")
    idx, key = idx[order], key[order]
    group = np.zeros(len(idx), np.int64)
    group[1:] = np.cumsum(key[1:] != key[:-1])
    for d in range(8, depth, 8):
        tied = np.zeros(len(idx), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        word = w[idx[at] + d]
        if d + 8 > depth:
            word = word & _last(depth)
        order = np.lexsort((word, group[at]))
        idx[at], word, own = idx[at[order]], word[order], group[at[order]]
        new = np.zeros(len(idx), bool)
        new[1:] = group[1:] != group[:-1]
        new[at[1:]] |= (word[1:] != word[:-1]) | (own[1:] != own[:-1])
        group = np.cumsum(new)
    return idx


def suffix_array(text: np.ndarray, depth: int, w: np.ndarray | None = None) -> np.ndarray:
    """All positions in the order of their suffixes' first ``depth`` bytes.

    Only suffixes smaller than their successors are sorted directly. The buckets of the first byte are then scanned
    upwards; each suffix found puts its predecessor, if that is larger, behind those that its bucket already has.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    w = _words(text, depth) if w is None else w
    # a suffix is smaller than its successor if its first run of equal bytes is followed by a larger byte
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    rise[-1] = -1
    end_of_run = np.where(rise != 0, np.arange(n), n)
    end_of_run = np.minimum.accumulate(end_of_run[::-1])[::-1]
    small = rise[end_of_run] > 0
    direct = _direct(np.flatnonzero(small), w, depth)
    cut = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        bucket = []
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(front):
            bucket.append(front)
            front = front[front > 0] - 1
            front = front[~small[front] & (text[front] == c)]
        bucket.append(direct[cut[c] : cut[c + 1]])
        own = np.concatenate(bucket)
        if not len(own):
            continue
        out.append(own)
        before = own[own > 0] - 1
        before = before[~small[before] & (text[before] > c)]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            edges = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, edges):
                waiting[text[part[0]]].append(part)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, w: np.ndarray, depth: int) -> np.ndarray:
    """Whether each entry shares ``depth`` bytes with the one before it."""
    same = np.zeros(len(order), bool)
    at = np.arange(1, len(order))
    for d in range(0, depth, 8):
        a, b = w[order[at] + d], w[order[at - 1] + d]
        if d + 8 > depth:
            a, b = a & _last(depth), b & _last(depth)
        at = at[a == b]
    same[at] = True
    return same


def repeated_windows(text: np.ndarray, valid: np.ndarray, doc: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` whose ``depth`` bytes also stand at an earlier (doc, start)."""
    w = _words(text, depth)
    order = suffix_array(text, depth, w)
    order = order[valid[order]]
    same = common_prefixes(order, w, depth)
    return order[_later(same, doc[order], start[order])]


def _later(same: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """In runs of equal entries: which are not at the smallest (doc, start) of their run."""
    run = np.cumsum(~same) - 1
    size = np.bincount(run, minlength=1)
    at = np.flatnonzero(size[run] > 1)
    out = np.zeros(len(same), bool)
    if len(at):
        order = np.lexsort((start[at], doc[at], run[at]))
        at = at[order]
        first = np.ones(len(at), bool)
        first[1:] = run[at[1:]] != run[at[:-1]]
        lead = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        out[at] = (doc[at] != doc[at[lead]]) | (start[at] != start[at[lead]])
    return out


# ---- anchors ---------------------------------------------------------------------------------------------------------


def passages(data: np.ndarray, at: np.ndarray, length: int):
    """Row, first and last window start, and anchor hash of each run of windows with one anchor, and the runs' own hashes.

    The anchor of a window is its leftmost gram of least hash, so equal windows have equal anchors. Windows never leave
    their row. The text is worked off in steps, so a long text takes no more memory than its windows' runs.
    """
    row, lo, hi, anchor, own = [], [], [], [], []
    span = length - GRAM + 1
    for begin in range(0, max(0, len(data) - length + 1), _STEP):
        stop = min(begin + _STEP, len(data) - length + 1)
        part = data[begin : stop + length - 1]
        sums = prefix_hash(part)
        grams = span_hash(sums, np.arange(len(part) - GRAM + 1), np.arange(GRAM, len(part) + 1))
        low, where = (grams >> np.uint64(32)).astype(np.uint32), np.arange(len(grams), dtype=np.int32)
        reach = 1
        while reach < span:
            shift = min(reach, span - reach)
            better = low[shift:] < low[: len(low) - shift]
            where = np.where(better, where[shift:], where[: len(where) - shift])
            low = np.where(better, low[shift:], low[: len(low) - shift])
            reach += shift
        s = np.arange(stop - begin)
        r = np.searchsorted(at, s + begin, "right") - 1
        fits = s + begin + length <= at[r + 1]
        s, r, p = s[fits], r[fits], where[: stop - begin][fits]
        if not len(s):
            continue
        new = np.ones(len(s), bool)
        new[1:] = (p[1:] != p[:-1]) | (r[1:] != r[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(s)])) - 1
        row.append(r[first])
        lo.append(s[first] + begin)
        hi.append(s[last] + begin)
        # least hashes crowd at zero; mixed again, they fill equal ranges equally
        anchor.append(mix(grams[p[first]] + np.uint64(1)))
        own.append(span_hash(sums, s[first], s[last] + length))
    if not row:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in (row, lo, hi, anchor, own))


def _own_view(ids: np.ndarray, data: np.ndarray, at: np.ndarray, length: int):
    """Runs of a block with their (doc, start), sorted by anchor and content; and which repeat an earlier one of the block."""
    row, lo, hi, anchor, own = passages(data, at, length)
    doc, start = ids[row], lo - at[row]
    order = np.lexsort((start, doc, own, anchor))
    row, lo, hi, anchor, own, doc, start = (x[order] for x in (row, lo, hi, anchor, own, doc, start))
    same = np.zeros(len(row), bool)
    same[1:] = (anchor[1:] == anchor[:-1]) & (own[1:] == own[:-1])
    later = _later(same, doc, start)
    return lo, hi, anchor, doc, start, same, later


def _cuts(values: np.ndarray, buckets: int) -> np.ndarray:
    edges = (np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets)) if buckets > 1 else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(values, edges), [len(values)]))


def _runs(start: np.ndarray, doc: np.ndarray, stop: np.ndarray):
    """Overlapping or touching byte ranges of a document as one."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if len(doc) == 0:
        return doc, start, stop
    # ends so far, within each document
    base = np.concatenate(([0], np.cumsum(doc[1:] != doc[:-1]))) * (np.int64(1) << np.int64(40))
    reach = np.maximum.accumulate(stop + base) - base
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.concatenate((first[1:], [len(doc)])) - 1]


# ---- the operator ----------------------------------------------------------------------------------------------------


def dedup(docs: DataFrame, length: int = 100, keep_text: bool = False, hot_passages: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``keep_text``, the kept text.

    Texts are UTF-8 bytes (null: empty). A byte goes if a ``length``-byte string over it also starts earlier: in a
    document of smaller id, or earlier in the same one. Strings are judged on the input and never cross documents;
    spans are maximal runs of bytes that go. Rows of one id are at equal places: neither is earlier than the other. The
    kept text is decoded without characters that were cut in two. Rows without id are left out. Other columns are not read; an empty table gives an
    empty result.

    1. Winnowing: each window of ``length`` bytes has one anchor. Blocks of documents send their distinct anchors to
       buckets of the anchor's hash and learn which occur in more than one passage.
    2. Passages around such anchors (the windows that share the anchor) go to the bucket, equal ones of a block once.
       A bucket builds two-stage suffix arrays over its different passages, takes adjacent common prefixes, and so finds
       each window that also stands earlier. Windows without a repeated anchor cannot repeat, and are never sorted.
    3. Anchors with more than ``hot_passages`` different passages would overfill a task; there each block sends the hashes of its
       distinct windows, spread by hash, and their smallest place decides.
    4. Blocks gather the ranges found for their documents.
    """
    docs = docs.filter(F.col(id_col).isNotNull())
    ids_type = docs.schema[id_col].dataType.simpleString()
    blocks = in_blocks(docs.withColumn(id_col, F.col(id_col).cast("bigint")), id_col, text_col, BLOCK_BYTES)
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    buckets = int(total // BUCKET_BYTES + 1)

    def column(table, name):
        return table.column(name).combine_chunks() if isinstance(table.column(name), pa.ChunkedArray) else table.column(name)

    def own_runs(table):
        data, at = flat(table.column(2))
        return data, _own_view(table.column(1).to_numpy(), data, at, length)

    def announce(key, table):
        _, (_, _, anchor, _, _, same, _) = own_runs(table)
        names, counts = np.unique(anchor[~same], return_counts=True)
        cuts = _cuts(names, buckets)
        some = np.flatnonzero(np.diff(cuts))
        small = np.minimum(counts, 0xFFFF).astype(np.uint16)
        return pa.table(
            {
                "block": pa.array(np.full(len(some), key[0].as_py(), np.int64)),
                "bucket": pa.array(some.astype(np.int64)),
                "anchors": pa.array([names[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
                "codes": pa.array([small[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
            }
        )

    def judge(key, table):
        names = [np.frombuffer(x.as_buffer(), np.uint64) for x in column(table, "anchors")]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in column(table, "codes")])
        _, place = np.unique(np.concatenate(names), return_inverse=True)
        sums = np.bincount(place, weights=counts)[place]
        codes = np.where(sums > hot_passages, 2, np.where(sums > 1, 1, 0)).astype(np.uint8)
        parts = np.split(codes, np.cumsum([len(x) for x in names])[:-1])
        return pa.table(
            {"block": table.column("block"), "bucket": table.column("bucket"), "anchors": pa.array([b""] * len(names), pa.binary()), "codes": pa.array([x.tobytes() for x in parts], pa.binary())}
        )

    def coded(key, left, right):
        """Runs of a block and the code of each one's anchor."""
        data, (lo, hi, anchor, doc, start, same, _) = own_runs(left)
        names = np.unique(anchor)
        cuts = _cuts(names, buckets)
        codes = np.zeros(len(names), np.uint8)
        for b, c in zip(right.column("bucket").to_pylist(), column(right, "codes")):
            codes[cuts[b] : cuts[b + 1]] = np.frombuffer(c.as_buffer(), np.uint8)
        return data, lo, hi, anchor, doc, start, ~same, codes[np.searchsorted(names, anchor)] if len(names) else np.zeros(0, np.uint8)

    def send(key, left, right):
        data, lo, hi, anchor, doc, start, first, code = coded(key, left, right)
        pick = first & (code == 1)
        lo, hi, anchor, doc, start = lo[pick], hi[pick], anchor[pick], doc[pick], start[pick]
        cuts = _cuts(anchor, buckets)
        some = np.flatnonzero(np.diff(cuts))
        out = {n: [] for n in ("anchors", "doc", "start", "size", "text")}
        for b in some:
            x = slice(cuts[b], cuts[b + 1])
            out["anchors"].append(anchor[x].tobytes())
            out["doc"].append(doc[x].tobytes())
            out["start"].append(start[x].astype(np.int64).tobytes())
            out["size"].append((hi[x] - lo[x] + length).astype(np.uint16 if length < 60000 else np.int64).tobytes())
            out["text"].append(b"".join(data[i:j].tobytes() for i, j in zip(lo[x].tolist(), (hi[x] + length).tolist())))
        head = {"block": pa.array(np.full(len(some), key[0].as_py(), np.int64)), "bucket": pa.array(some.astype(np.int64))}
        return pa.table(head | {n: pa.array(v, pa.binary()) for n, v in out.items()})

    def gathered(table, names):
        kinds = {"anchors": np.uint64, "doc": np.int64, "start": np.int64, "size": np.uint16 if length < 60000 else np.int64, "text": np.uint8, "hash": np.uint64}
        parts = {n: [np.frombuffer(x.as_buffer(), kinds[n]) for x in column(table, n)] for n in names}
        block = np.repeat(table.column("block").to_numpy(), [len(x) for x in parts["doc"]])
        return block, {n: np.concatenate(v) for n, v in parts.items()}

    def answer(block, doc, start, stop):
        """One row per block with its ranges."""
        order = np.argsort(block, kind="stable")
        block, doc, start, stop = block[order], doc[order], start[order], stop[order]
        names, first = np.unique(block, return_index=True)
        out = [_runs(start[a:b], doc[a:b], stop[a:b]) for a, b in zip(first, [*first[1:], len(block)])]
        return pa.table(
            {
                "block": pa.array(names.astype(np.int64)),
                "doc": pa.array([x[0].tobytes() for x in out], pa.binary()),
                "start": pa.array([x[1].tobytes() for x in out], pa.binary()),
                "stop": pa.array([x[2].tobytes() for x in out], pa.binary()),
            }
        )

    def sort(key, table):
        block, x = gathered(table, ("anchors", "doc", "start", "size", "text"))
        size = x["size"].astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(size)))[:-1]
        # equal passages of different blocks are one passage, at its smallest place
        name = np.zeros(len(size), np.uint64)
        for i, j in chunks(np.append(begin, len(x["text"]))):
            at = begin[i]
            name[i:j] = span_hash(prefix_hash(x["text"][at : begin[j - 1] + size[j - 1]]), begin[i:j] - at, begin[i:j] - at + size[i:j])
        order = np.lexsort((x["start"], x["doc"], name, x["anchors"]))
        same = np.zeros(len(order), bool)
        same[1:] = (x["anchors"][order][1:] == x["anchors"][order][:-1]) & (name[order][1:] == name[order][:-1])
        again = _later(same, x["doc"][order], x["start"][order])
        late = order[again]
        found = [(block[late], x["doc"][late], x["start"][late], x["start"][late] + size[late])]
        kept = order[~same]
        edges = np.flatnonzero(np.concatenate(([True], x["anchors"][kept][1:] != x["anchors"][kept][:-1])))
        sums = np.concatenate(([0], np.cumsum(size[kept])))
        # passages of an anchor that has only one are done
        k = 0
        bounds = [*edges.tolist(), len(kept)]
        batch, held = [], 0
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a > 1:
                batch.append(kept[a:b])
                held += sums[b] - sums[a]
            if held >= ARRAY_BYTES or (b == len(kept) and batch):
                found.append(windows(np.concatenate(batch), block, x, begin, size))
                batch, held = [], 0
        return answer(*(np.concatenate(v) for v in zip(*found)))

    def windows(pick, block, x, begin, size):
        n = size[pick]
        at = np.concatenate(([0], np.cumsum(n)))
        inside = np.arange(at[-1]) - np.repeat(at[:-1], n)
        text = x["text"][np.repeat(begin[pick], n) + inside]
        run = np.repeat(np.arange(len(pick)), n)
        hit = repeated_windows(text, inside + length <= n[run], x["doc"][pick][run], x["start"][pick][run] + inside, length)
        own = pick[run[hit]]
        s = x["start"][own] + inside[hit]
        return block[own], x["doc"][own], s, s + length

    def send_hot(key, left, right):
        data, lo, hi, anchor, doc, start, first, code = coded(key, left, right)
        pick = np.flatnonzero(first & (code == 2))
        n = hi[pick] - lo[pick] + 1
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own = np.repeat(pick, n)
        pos = lo[own] + inside
        rows = [np.zeros(0, np.uint64)] * 2
        if len(pos):
            sums = prefix_hash(data)
            rows = [span_hash(sums, pos, pos + length), span_hash(sums, pos, pos + length // 2)]
        d, s = doc[own], start[own] + inside
        order = np.lexsort((s, d, rows[1], rows[0]))
        a, b, d, s = rows[0][order], rows[1][order], d[order], s[order]
        cuts = _cuts(a, buckets)
        some = np.flatnonzero(np.diff(cuts))
        pair = np.stack((a, b), 1)
        head = {"block": pa.array(np.full(len(some), key[0].as_py(), np.int64)), "bucket": pa.array(some.astype(np.int64))}
        cut = [slice(cuts[k], cuts[k + 1]) for k in some]
        return pa.table(
            head
            | {
                "hash": pa.array([pair[c].tobytes() for c in cut], pa.binary()),
                "doc": pa.array([d[c].tobytes() for c in cut], pa.binary()),
                "start": pa.array([s[c].astype(np.int64).tobytes() for c in cut], pa.binary()),
            }
        )

    def decide_hot(key, table):
        block, x = gathered(table, ("hash", "doc", "start"))
        pair = x["hash"].reshape(-1, 2)
        order = np.lexsort((x["start"], x["doc"], pair[:, 1], pair[:, 0]))
        same = np.zeros(len(order), bool)
        same[1:] = (pair[order][1:] == pair[order][:-1]).all(axis=1)
        late = order[_later(same, x["doc"][order], x["start"][order])]
        return answer(block[late], x["doc"][late], x["start"][late], x["start"][late] + length)

    schema = f"{id_col} {ids_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept_text string" if keep_text else "")
    arrow_id = {"int": pa.int32(), "bigint": pa.int64()}.get(ids_type, pa.int64())

    def finish(key, left, right):
        data, (lo, hi, _, doc, _, _, later) = own_runs(left)
        ids, (_, at) = left.column(1).to_numpy(), flat(left.column(2))
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, lo[later], 1)
        np.add.at(change, hi[later] + length, -1)
        by_id = np.argsort(ids, kind="stable")
        for d, s, e in zip(*(column(right, n) for n in ("doc", "start", "stop"))):
            d, s, e = (np.frombuffer(v.as_buffer(), np.int64) for v in (d, s, e))
            # every row of the id, should it stand there more than once
            k, n = np.searchsorted(ids[by_id], d), np.searchsorted(ids[by_id], d, "right")
            while len(d):
                row = by_id[k]
                np.add.at(change, at[row] + s, 1)
                np.add.at(change, at[row] + e, -1)
                k = k + 1
                more = k < n
                d, s, e, k, n = d[more], s[more], e[more], k[more], n[more]
        gone = np.cumsum(change[:-1]) > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        starts = at[:-1][at[:-1] < len(data)]
        opens[starts] = gone[starts]
        rows = [np.concatenate(([0], np.cumsum(v)))[at] for v in (gone, opens)]
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(at[:-1], at[1:])]
        cols = {
            id_col: left.column(1).cast(arrow_id),
            "n_bytes": pa.array(np.diff(at)),
            "n_removed": pa.array(np.diff(rows[0])),
            "n_spans": pa.array(np.diff(rows[1])),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        if keep_text:
            cols["kept_text"] = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
        return pa.table(cols)

    by_block = blocks.groupBy("block")
    codes = by_block.applyInArrow(announce, _ANSWER).groupBy("bucket").applyInArrow(judge, _ANSWER)
    sent = by_block.cogroup(codes.groupBy("block")).applyInArrow(send, _PASSAGES)
    hot = by_block.cogroup(codes.groupBy("block")).applyInArrow(send_hot, _WINDOWS)
    ranges = sent.groupBy("bucket").applyInArrow(sort, _RUNS).unionByName(hot.groupBy("bucket").applyInArrow(decide_hot, _RUNS))
    return by_block.cogroup(ranges.groupBy("block")).applyInArrow(finish, schema)

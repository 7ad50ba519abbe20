"""SentencePiece encoding and decoding of merge-type models, by backtracking over Aho-Corasick matches."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from .bpe import read_ranks
from .common import parts

SPACE = "▁"
#: Characters of a text that are encoded at once; slices end where no piece can go on.
SLICE_CHARS = 1 << 18
#: Words and pairs that a worker remembers; beyond it forgets all of them.
WORDS_MOST, PAIRS_MOST = 600_000, 600_000

Plain = tuple[list[str], list[float], list[int], dict[int, int], tuple[int, int]]


def read_model(path: str) -> Plain:
    """(pieces, scores, ids) that texts are made of, the id of each byte, (begin, end); read on the driver.

    The model must merge (not a unigram model), fall back to bytes, keep texts as they are and mark spaces at the front.
    """
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(read_ranks(path))
    kind, norm = sentencepiece_model_pb2.ModelProto.SentencePiece, model.normalizer_spec
    named = {p.piece: i for i, p in enumerate(model.pieces)}
    plain = [(p.piece, p.score, i) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
    byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
    odd = any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces)
    as_is = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
    merges = model.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE and not model.trainer_spec.treat_whitespace_as_suffix
    if not (merges and as_is and len(byte) == 256) or odd or max(len(p) for p, _, _ in plain) > 63:
        raise ValueError(f"{path}: not a merge-type model with byte fallback and untouched texts")
    bos, eos = model.trainer_spec.bos_piece, model.trainer_spec.eos_piece
    return [p for p, _, _ in plain], [s for _, s, _ in plain], [i for _, _, i in plain], byte, (named[bos], named[eos])


def _class(chars) -> str:
    return "[" + "".join(map(re.escape, sorted(chars))) + "]"


class Codec:
    """One model: an automaton of the pieces that merging can leave, and remembered words and pairs."""

    def __init__(self, model: Plain):
        names, scores, ids, byte, (self.begin, self.end) = model
        self.score = dict(zip(names, scores))
        known = {c for p in names for c in p} - {SPACE}
        self.ids = {p: (i,) for p, i in zip(names, ids)}
        for c in known - self.ids.keys():  # in longer pieces only: alone it is written as bytes
            self.ids[c] = tuple(byte[b] for b in c.encode())
        self.of_byte = [byte[b] for b in range(256)]
        self.bytes_of: dict[int, bytes] = {i: p.replace(SPACE, " ").encode() for p, i in zip(names, ids)}
        self.bytes_of |= {i: bytes([b]) for b, i in byte.items()} | {self.begin: b"", self.end: b""}
        # what merging its own characters does not give back never stands in a result
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in self.ids:
            if len(p) == 1 or self.merge(p) == [p]:
                self.automaton.add_word(p)
        self.automaton.add_word(SPACE)
        self.automaton.make_automaton()
        self.find = re.compile(self._pattern(names, known), re.DOTALL).findall
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _pattern(self, names: list[str], known: set[str]) -> str:
        """Words: runs of a text that no piece crosses the end of, so that they are encoded alone."""
        inside = [(a, b) for p in names for a, b in zip(p, p[1:])]
        self.breaks = not any(b == SPACE != a for a, b in inside)
        letters = {c for c in known if c.isalpha()}
        if not self.breaks:
            return f"{_class(known | {SPACE})}+|."
        if any(SPACE != a and (a in letters) != (b in letters) for a, b in inside) or not letters or letters == known:
            return f"{SPACE}*{_class(known)}+|{SPACE}+|."
        return f"{SPACE}*(?:{_class(letters)}+|{_class(known - letters)}+)|{SPACE}+|."

    def merge(self, text: str) -> list[str]:
        """Merging itself: the best-scored adjacent pair, the leftmost of equals, until none is a piece."""
        out, score = list(text), self.score
        while len(out) > 1:
            best, at = None, 0
            for k in range(len(out) - 1):
                s = score.get(out[k] + out[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out

    def fit(self, left: str, right: str) -> bool:
        """Whether merging leaves these two side by side; anything fits the beginning."""
        if len(self.pairs) > PAIRS_MOST:
            self.pairs.clear()
        ok = self.pairs[left, right] = not left or self.merge(left + right) == [left, right]
        return ok

    def backtrack(self, word: str) -> list[str]:
        """Pieces of which all neighbours fit: there is one such sequence to every place, the merged one.

        From the left the longest match that fits is taken; where none does, the place is marked as failed and the piece
        before it gives way to its next shorter match. A place is left for good once, so the work is linear.
        """
        n, pairs = len(word), self.pairs
        lengths = [0] * n if n <= 64 else array("Q", bytes(8 * n))  # bit k: a piece of k characters begins here
        for last, k in self.automaton.iter(word):
            lengths[last - k + 1] |= 1 << k
        failed, some = bytearray(n // 8 + 1), False
        out: list[str] = []
        at, may, before = 0, lengths[0], ""
        while at < n:
            while may:
                k = may.bit_length() - 1
                end = at + k
                if not (some and failed[end >> 3] >> (end & 7) & 1):
                    piece = word[at:end]
                    ok = pairs.get((before, piece))
                    if self.fit(before, piece) if ok is None else ok:
                        break
                may ^= 1 << k
            if may:
                out.append(piece)
                at, before = end, piece
                may = lengths[at] if at < n else 0
            else:
                failed[at >> 3] |= 1 << (at & 7)
                some = True
                k = len(out.pop())
                at, before = at - k, out[-1] if out else ""
                may = lengths[at] & ((1 << k) - 1)
        return out

    def learn(self, word: str) -> tuple[int, ...]:
        if len(word) == 1 and word not in self.ids and word != SPACE:  # in no piece at all
            ids = tuple(self.of_byte[b] for b in word.encode())
        else:
            ids = tuple([i for p in self.backtrack(word) for i in self.ids[p]])
        if len(word) <= 64:
            if len(self.words) > WORDS_MOST:
                self.words.clear()
            self.words[word] = ids
        return ids

    def slices(self, text: str) -> Iterator[str]:
        """A text with marked spaces, cut where a word ends."""
        at, n = 0, len(text)
        while n - at > SLICE_CHARS and self.breaks:
            cut = _END.search(text, at + SLICE_CHARS)
            if cut is None:
                break
            yield text[at : cut.end()].replace(" ", SPACE)
            at = cut.end()
        yield text[at:].replace(" ", SPACE)

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids slice by slice, with those of begin and end."""
        ids, words = [self.begin], self.words
        if text:
            for some in self.slices(" " + text):
                for w in self.find(some):
                    ids += words.get(w) or self.learn(w)
                yield ids
                ids = []
        ids.append(self.end)
        yield ids

    def decode(self, chunks: Iterator[list[int]]) -> Iterator[bytes]:
        """UTF-8 of the text; the space that encoding put in front goes."""
        front = True
        for ids in chunks:
            raw = b"".join(map(self.bytes_of.__getitem__, ids))
            if front and raw:
                raw, front = raw.removeprefix(b" "), False
            yield raw


_END = re.compile(rf"[^ {SPACE}](?=[ {SPACE}])")
_codecs: dict[int, Codec] = {}


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode every whole text as the sentencepiece library does with the model, and decode the ids again.

    Returns id_col, ids array<int> (only with ``keep_ids``; begin and end included), n_tokens (all ids), ids_sha256 (ids as
    little-endian unsigned 32-bit integers) and decoded_sha256 (the decoded text in UTF-8). Null and empty texts have the
    ids of begin and end alone. A marked space (U+2581) in a text is read as a space, as the library does. Repeated rows
    give repeated results, rows without id theirs, an empty table an empty result; other columns are not read. A projection:
    no shuffle, a lost task is just run again. A text is read in slices, so beside the ids (with ``keep_ids``) memory is
    bounded by the slice and the remembered words; a text without a break is one slice of some 12 bytes a character.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}" + (", ids array<int>" if keep_ids else "") + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        key = hash((len(model.value[0]), model.value[0][-1], model.value[4]))
        if key not in _codecs:
            _codecs.clear()
            _codecs[key] = Codec(model.value)
        own = _codecs[key]
        for batch in parts(batches):
            every, n, a, b = [], [], [], []
            for value in batch.column(1):
                n.append(0)
                of_ids, of_text, kept = hashlib.sha256(), hashlib.sha256(), array("i")

                def seen(text):
                    for ids in own.encode(text):
                        n[-1] += len(ids)
                        of_ids.update(np.array(ids, "<u4").tobytes())
                        if keep_ids:
                            kept.extend(ids)
                        yield ids

                for raw in own.decode(seen(value.as_py() or "")):
                    of_text.update(raw)
                a.append(of_ids.hexdigest())
                b.append(of_text.hexdigest())
                every.append(np.frombuffer(kept, np.int32))
            cols = [batch.column(0)] + ([pa.array(every, pa.list_(pa.int32()))] if keep_ids else [])
            names = [id_col] + (["ids"] if keep_ids else []) + ["n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)

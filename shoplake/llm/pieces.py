"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

The pieces, scores and normaliser settings come from a public SentencePiece model file; the segmentation
with the largest sum of scores is found, whatever model the file was made for. Characters that no piece
covers are written as byte pieces. Since pieces hold the white-space marker only at their front, a text
falls into words that are segmented independently; equal words of a task are segmented once.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
# Fixed values of the model file format: piece types, and the score of an unknown character below the lowest score.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
MEMO_WORDS = 250_000  # words a task remembers; it then starts anew
MEMO_LENGTH = 64
PIECE_CHARS = 1 << 20  # a longer text is cut before a white space near this length
CHUNK_CHARS = 1 << 17  # characters of short texts that are segmented together


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool
    byte_fallback: bool

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Read a model file (on the driver). Only the identity normaliser is supported."""
        with open(path, "rb") as f:
            data = f.read()
        pieces, scores, kinds = [], [], []
        prefix, fallback = True, False
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                fallback = bool(dict(_fields(value)).get(35, 0))
            elif field == 3:
                settings = dict(_fields(value))
                prefix = bool(settings.get(3, 1))
                if settings.get(2) or settings.get(4, 1) or not settings.get(5, 1):
                    raise ValueError("only models with the identity normaliser that keep white space are supported")
        return cls(pieces, scores, kinds, prefix, fallback)


class DoubleArray:
    """Byte trie in two arrays: the child of state s by byte c is t = base[s] + c if check[t] == s."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        self.base, self.check, self.value = [0] * 1024, [-1] * 1024, [-1] * 1024
        self.check[0] = 0
        first_free = 1
        todo = [(0, 0, len(keys), 0)]  # state, range of keys, depth
        while todo:
            state, low, high, depth = todo.pop()
            if len(keys[low][0]) == depth:
                self.value[state] = keys[low][1]
                low += 1
            children, at = [], low
            while at < high:
                byte, start = keys[at][0][depth], at
                while at < high and keys[at][0][depth] == byte:
                    at += 1
                children.append((byte, start, at))
            if not children:
                continue
            while self.check[first_free] >= 0:
                first_free += 1
                self._grow(first_free)
            slot = first_free
            while True:
                base = slot - children[0][0]
                self._grow(base + 256)
                if base >= 0 and all(self.check[base + byte] < 0 for byte, _, _ in children):
                    break
                slot += 1
            if slot - first_free > 64:  # mostly taken up to here: gaps are left behind
                first_free = slot
            self.base[state] = base
            for byte, start, end in children:
                self.check[base + byte] = state
                todo.append((base + byte, start, end, depth + 1))
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (self.base, self.check, self.value))

    def _grow(self, size: int) -> None:
        if size >= len(self.check):
            more = max(len(self.check), size + 1 - len(self.check))
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more


class Segmenter:
    """Encodes and decodes texts. Small enough to be broadcast: its size is set by the vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        usable = [(p.encode(), i) for i, (p, k) in enumerate(zip(v.pieces, v.kinds, strict=True))
                  if k in (NORMAL, USER_DEFINED) and p]
        self.trie = DoubleArray(usable)
        self.longest = max(len(p) for p, _ in usable)
        self.scores = np.array(v.scores, np.float64)
        self.unknown_score = min(v.scores[i] for _, i in usable) - UNKNOWN_PENALTY
        self.unknown = next((i for i, k in enumerate(v.kinds) if k == UNKNOWN), 0)
        self.bytes_of = np.full(256, self.unknown, np.int32)
        self.falls_back = v.byte_fallback
        for i, k in enumerate(v.kinds):
            if k == BYTE:
                self.bytes_of[int(v.pieces[i][3:5], 16)] = i
        self.prefix = v.dummy_prefix
        self.output = [self._bytes(v, i) for i in range(len(v.pieces))]
        if any(MARK in p.decode().lstrip(MARK) for p, _ in usable):
            self.words = re.compile(r"(?s).+")
        else:
            joined = sorted({c for p, _ in usable for c in p.decode() if len(p.decode()) > 1} - {MARK})
            inner = "[" + "".join(re.escape(c) for c in joined) + "]"
            # Characters outside of all longer pieces stand alone.
            self.words = re.compile(rf"(?s){MARK}+{inner}*|{inner}+|.")
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def _bytes(v: Vocabulary, i: int) -> bytes:
        if v.kinds[i] == BYTE:
            return bytes([int(v.pieces[i][3:5], 16)])
        if v.kinds[i] == CONTROL:
            return b""
        if v.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        return v.pieces[i].replace(MARK, " ").encode()

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian int32) of each word's best segmentation; of equal sums the longer last piece wins."""
        if not words:
            return []
        encoded = [w.encode("utf-8", "surrogatepass") for w in words]
        text = np.frombuffer(b"".join(encoded), np.uint8)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ends = np.cumsum(lengths)
        word_of = np.repeat(np.arange(len(words)), lengths)
        begin = (ends - lengths)[word_of]
        # Walk the trie from every character of every word at once.
        starts = np.flatnonzero((text & 0xC0) != 0x80)
        char_length = np.diff(np.r_[starts, len(text)])
        char_end = starts + char_length
        single = np.zeros(len(starts), bool)
        edge_start, edge_end, edge_id = [], [], []
        active, state = np.arange(len(starts)), np.zeros(len(starts), np.int64)
        trie = self.trie
        for depth in range(self.longest):
            at = starts[active] + depth
            inside = at < ends[word_of[starts[active]]]
            active, state, at = active[inside], state[inside], at[inside]
            target = trie.base[state] + text[at].astype(np.int64)
            target[target >= len(trie.check)] = 0
            found = (trie.check[target] == state) & (target > 0)
            active, state = active[found], target[found]
            if not len(active):
                break
            piece = trie.value[state]
            known = piece >= 0
            edge_start.append(starts[active[known]])
            edge_end.append(starts[active[known]] + depth + 1)
            edge_id.append(piece[known])
            single[active[known & (starts[active] + depth + 1 == char_end[active])]] = True
        edge_start.append(starts[~single])
        edge_end.append(char_end[~single])
        edge_id.append(np.full(int((~single).sum()), -1, np.int32))
        start, end, piece = (np.concatenate(x) for x in (edge_start, edge_end, edge_id))
        score = np.where(piece >= 0, self.scores[piece], self.unknown_score)
        # Viterbi over all words side by side, by the byte distance from the word's begin. A boundary gets
        # a slot of its own per word: byte position plus word number.
        word = word_of[start]
        from_slot, to_slot = start + word, end + word
        distance = end - begin[start]
        order = np.lexsort((start, to_slot, distance))
        start, end, piece, score, from_slot, to_slot, distance = (
            x[order] for x in (start, end, piece, score, from_slot, to_slot, distance))
        best = np.full(len(text) + len(words), -np.inf)
        back = np.zeros(len(best), np.int64)
        best[(ends - lengths) + np.arange(len(words))] = 0.0
        cuts = np.flatnonzero(np.r_[True, distance[1:] != distance[:-1]])
        for low, high in zip(cuts, np.r_[cuts[1:], len(distance)], strict=True):
            slots, total = to_slot[low:high], best[from_slot[low:high]] + score[low:high]
            firsts = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]])
            top = np.maximum.reduceat(total, firsts)
            best[slots[firsts]] = top
            winners = np.flatnonzero(total == np.repeat(top, np.diff(np.r_[firsts, high - low])))[::-1]
            back[slots[winners]] = winners + low  # the earliest start is written last
        # Walk back from all word ends together.
        now = np.flatnonzero(lengths > 0)
        slot = ends[now] + now
        out_word, out_id, step = [], [], 0
        out_step = []
        while len(now):
            edge = back[slot]
            known = piece[edge] >= 0
            out_word.append(now[known])
            out_id.append(piece[edge[known]])
            out_step.append(np.full(int(known.sum()), step))
            missing = edge[~known]
            if len(missing) and not self.falls_back:
                out_word.append(now[~known])
                out_id.append(np.full(len(missing), self.unknown, np.int32))
                out_step.append(np.full(len(missing), step))
            elif len(missing):
                for k in range(4):
                    long_enough = end[missing] - start[missing] > k
                    out_word.append(now[~known][long_enough])
                    out_id.append(self.bytes_of[text[end[missing[long_enough]] - 1 - k]])
                    out_step.append(np.full(int(long_enough.sum()), step + k))
            step += 4
            slot = from_slot[edge]
            going = start[edge] > (ends - lengths)[now]
            now, slot = now[going], slot[going]
        w, i, s = np.concatenate(out_word), np.concatenate(out_id), np.concatenate(out_step)
        order = np.lexsort((-s, w))
        flat = i[order].astype("<i4").tobytes()
        upto = (4 * np.cumsum(np.bincount(w, minlength=len(words)))).tolist()
        return [flat[a:b] for a, b in zip([0, *upto[:-1]], upto, strict=True)]

    def _words(self, text: str) -> Iterator[list[str]]:
        """The words of a text, in lists; a long text is cut before a white space that follows something else."""
        text = text.replace(" ", MARK)
        if self.prefix and text:
            text = MARK + text
        at = 0
        while at < len(text):
            end = at + PIECE_CHARS
            if end < len(text):
                cut = re.compile(f"[^{MARK}](?={MARK})").search(text, end)
                end = cut.end() if cut else len(text)
            yield self.words.findall(text[at:end])
            at = end

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text."""
        done: list[np.ndarray] = []
        waiting: list[list[str]] = []
        size = 0

        def flush() -> None:
            nonlocal waiting, size
            memo = self.memo
            if len(memo) > MEMO_WORDS:
                memo.clear()
            new = list(set().union(*waiting) - memo.keys())
            memo.update(zip(new, self.segment(new), strict=True))
            for words in waiting:
                done.append(np.frombuffer(b"".join(map(memo.__getitem__, words)), "<i4"))
            for w in new:
                if len(w) > MEMO_LENGTH:
                    del memo[w]
            waiting, size = [], 0

        for text in texts:
            if len(text) <= PIECE_CHARS:
                waiting.append(next(self._words(text), []))
                size += len(text)
                if size >= CHUNK_CHARS:
                    flush()
            else:
                flush()
                at = len(done)
                for words in self._words(text):
                    waiting.append(words)
                    flush()
                done[at:] = [np.concatenate(done[at:])]
        flush()
        return done

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids: markers become spaces, byte pieces their bytes (invalid ones U+FFFD), and the space
        that encoding put in front goes."""
        text = b"".join([self.output[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode(docs: DataFrame, segmenter: Segmenter, text: str = "text", ids: str = "ids",
           keep_text: bool = False) -> DataFrame:
    """Add ``ids`` (array of int), in place of the text unless ``keep_text``. Null and empty texts have no ids;
    rows and the other columns stay as they are. A U+2581 in a text is taken for a space. An empty table
    stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(segmenter)
    rest = [c for c in docs.columns if c not in (text, ids)] + [text] * keep_text
    read = docs.select(*[c for c in rest if c != text], text)
    place = read.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.encode(t or "" for t in batch.column(place).to_pylist())
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, "<i4"), *found]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.ListArray.from_arrays(ends, values)],
                                             names=[*rest, ids])

    return read.mapInArrow(run, docs.select(*rest, F.array(F.lit(0)).alias(ids)).schema)


def decode(encoded: DataFrame, segmenter: Segmenter, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add column ``text``, the text of column ``ids`` (null as no ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast(segmenter)
    kept = [c for c in encoded.columns if c != text]
    place = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(place)
            values, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
            starts = np.r_[0, ends[:-1]]
            texts = [shared.value.decode(values[a:b].tolist()) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, text])

    rows = encoded.select(*kept)
    return rows.mapInArrow(run, encoded.select(*kept, F.lit("").alias(text)).schema)

"""Language-model scores by deleted interpolation.

A word's probability after another mixes three estimates: the bigram's and the word's maximum-likelihood
estimates and a uniform share. The mixture weights depend on how often the context occurs (buckets of
powers of two) and are learned by expectation-maximisation on the bigram counts of held-out documents.

Every training word is a context with a count of its own. Map tasks turn blocks of some million tokens into
distinct keys: 64-bit hashes of the block's (context, word) pairs and of its words, with their counts. The
keys are dealt by their leading bits to nodes that sum them up and answer every block with the sums of its keys.
A block, or a node, has about as many keys and deals to a bounded number of nodes, so rows grow with the
tokens; beyond some ten thousand blocks the nodes are stacked, each level summing what the one below it
dealt.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import crc_of_id, materialize, word_lists

BLOCK_TOKENS = 1_000_000
TOKEN_BYTES = 4  # a token's share of the texts, about, by which the number of blocks is foreseen
SLICE = 1 << 19  # tokens scored at a time, to bound memory
LEVEL = 6  # of the compression
FAN_BITS = 12  # a block or node deals to 2^FAN_BITS nodes at most
VOCABULARY = 150_000  # words a task remembers; it then starts anew
CELLS_PER_OCTAVE = 4  # estimates are rounded to quarter powers of two for learning the weights
FIT, HELD, TEST = 0, 1, 2
END = b"\n"  # no word holds white space
# Stand for the begin of a text, and for a pair that is a single word, among the words' hashes.
BEGIN, ALONE = (np.uint64(xxhash.xxh64_intdigest(x, 1)) for x in (b" ", b"  "))


class _Vocabulary(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass
class Block:
    """Tokens of some documents: word and context (numbers in ``vocabulary``, -1 for a text's begin), document."""

    number: int
    rows: np.ndarray
    doc_ids: list[int | None]
    folds: np.ndarray
    words: np.ndarray
    contexts: np.ndarray
    docs: np.ndarray
    vocabulary: list[bytes]


def fold_of(doc_id: int | None, every: int = 5, held_share: int = 10) -> int:
    """TEST if crc32 of the id as text modulo ``every`` is 1; of the others one in ``held_share`` is HELD, the rest FIT."""
    crc = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if crc % every == 1:
        return TEST
    return HELD if crc // every % held_share == 0 else FIT


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Block]:
    """Blocks of ``limit`` tokens or more of the documents (doc_id, text) of a task. A very long text may span blocks."""
    task = TaskContext.get().partitionId()
    vocabulary = _Vocabulary()
    number, row = task << 32, task << 40
    rows: list[int] = []
    ids: list[int | None] = []
    words: list[np.ndarray] = []
    firsts: list[int] = []
    tokens, before = 0, -1

    def done() -> Block:
        lengths = [len(w) for w in words]
        flat = np.concatenate(words)
        contexts = np.concatenate([np.full(1, -1, np.int32), flat[:-1]])
        starts = np.cumsum([0, *lengths[:-1]])
        contexts[starts] = firsts
        return Block(number, np.array(rows), list(ids), np.array([fold_of(i) for i in ids]), flat, contexts,
                     np.repeat(np.arange(len(rows), dtype=np.int32), lengths), list(vocabulary))

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            doc_id, text = doc_id.as_py(), text.as_py()
            row, before, last = row + 1, -1, False
            pieces = word_lists(text)
            while not last:
                piece = next(pieces, None)
                last = piece is None
                found = (np.array([vocabulary[END]], np.int32) if last
                         else np.fromiter(map(vocabulary.__getitem__, piece), np.int32, len(piece)))
                if rows and rows[-1] == row:
                    words[-1] = np.concatenate([words[-1], found])
                else:
                    rows.append(row)
                    ids.append(doc_id)
                    words.append(found)
                    firsts.append(before)
                tokens += len(found)
                if tokens >= limit:
                    yield done()
                    number, before = number + 1, int(found[-1])
                    rows, ids, words, firsts, tokens = [], [], [], [], 0
                    if len(vocabulary) > VOCABULARY:
                        word = None if last else piece[-1]
                        vocabulary = _Vocabulary()
                        before = -1 if last else vocabulary[word]
    if rows:
        yield done()


# --- packed arrays -----------------------------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays, byte by byte of equal place, compressed: small numbers and few distinct ones take little."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        out += [struct.pack("<cq", a.dtype.char.encode(), len(a)), a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()]
    data = b"".join(out)
    return struct.pack("<q", len(data)) + pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    data = pa.decompress(memoryview(data)[8:], struct.unpack_from("<q", data)[0], "zstd", asbytes=True)
    out, at = [], 0
    while at < len(data):
        kind, n = struct.unpack_from("<cq", data, at)
        at += 9
        dtype = np.dtype(kind.decode())
        planes = np.frombuffer(data, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(n))
        at += n * dtype.itemsize
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.zeros(1, ascending.dtype))


# --- the model ---------------------------------------------------------------------------------------------------

@dataclass
class Weights:
    """Mixture weights (bigram, word, uniform) for each bucket of context counts; bucket 0: contexts without counts."""

    by_bucket: np.ndarray

    def probability(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
        bigram = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
        w = self.by_bucket[bucket(context)]
        return w[:, 0] * bigram + w[:, 1] * word / max(tokens, 1) + w[:, 2] / (distinct + 1)


BUCKETS = 64


def bucket(context_counts: np.ndarray) -> np.ndarray:
    return np.where(context_counts > 0, np.floor(np.log2(np.maximum(context_counts, 1))).astype(int) + 1, 0)


def learn_weights(cells: pd.DataFrame, distinct: int, rounds: int = 100) -> Weights:
    """Expectation-maximisation over held-out counts: columns bucket, bigram, word (estimates), n."""
    if not distinct:  # no training tokens: only the uniform share is a distribution
        return Weights(np.tile([0.0, 0.0, 1.0], (BUCKETS, 1)))
    least = 1e-4
    start = np.array([0.5, 0.4, 0.1])

    def fitted(part: pd.DataFrame, w: np.ndarray) -> np.ndarray:
        estimates = np.stack([part["bigram"], part["word"], np.full(len(part), 1 / (distinct + 1))], axis=1)
        n = part["n"].to_numpy(np.float64)
        if not n.sum():
            return w
        for _ in range(rounds):
            share = w * estimates
            share /= share.sum(axis=1, keepdims=True)
            w = np.maximum((share * n[:, None]).sum(axis=0) / n.sum(), least)
            w /= w.sum()
        return w

    pooled = fitted(cells[cells["bucket"] > 0], start)
    out = np.tile(pooled, (BUCKETS, 1))
    for b, part in cells.groupby("bucket"):
        out[int(b)] = fitted(part, pooled)
    # A context without counts has no bigram estimate: its share would be lost.
    out[0, 0] = 0.0
    out[0] /= out[0].sum()
    return Weights(out)


# --- a block's keys -----------------------------------------------------------------------------------------------

def pair_keys(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """64-bit identity of each pair, from the hashes of its context and word."""
    with np.errstate(over="ignore"):
        x = contexts * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x += words
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return x


def _ranked(counts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The order with frequent values first (by powers of two), so that their numbers are small."""
    return order[np.argsort(-np.frexp(counts[order])[1], kind="stable")]


@dataclass
class Tokens:
    """Words and contexts of a block as numbers in ``vocabulary``; the number after the last is a text's begin."""

    words: np.ndarray
    contexts: np.ndarray
    vocabulary: list[bytes]

    @classmethod
    def of(cls, b: Block) -> Tokens:
        """The block's words numbered anew, frequent ones first and then in order, so that numbers and words pack well."""
        counts = np.bincount(b.words, minlength=len(b.vocabulary))
        seen = counts > 0
        seen[b.contexts[b.contexts >= 0]] = True  # a text's first context may stand in the block before
        used = np.array(sorted(np.flatnonzero(seen).tolist(), key=b.vocabulary.__getitem__))
        used = _ranked(counts, used)
        number = np.zeros(len(b.vocabulary) + 1, np.int32)
        number[used] = np.arange(len(used), dtype=np.int32)
        number[-1] = len(used)
        return cls(number[b.words], number[b.contexts], [b.vocabulary[i] for i in used.tolist()])

    def keys(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Sorted keys of the pairs and every token's number among them; sorted keys of the words, the begin included,
        and every word's number among them."""
        hashes = np.array([*(xxhash.xxh64_intdigest(w, 1) for w in self.vocabulary), BEGIN], np.uint64)
        return (_distinct(pair_keys(hashes[self.contexts], hashes[self.words])),
                _distinct(pair_keys(np.full(len(hashes), ALONE), hashes)))


BEGINS = pair_keys(np.full(1, ALONE), np.full(1, BEGIN))[0]  # the key under which texts are counted


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and every value's number among them."""
    order = np.argsort(values)
    ascending = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    numbers = np.empty(len(values), np.int32)
    numbers[order] = np.cumsum(new, dtype=np.int32) - 1
    return ascending[new], numbers


# --- dealing keys and answering them --------------------------------------------------------------------------

DEALT = "node long, child long, own boolean, data binary"


@dataclass
class Levels:
    """How keys are dealt: ``bits`` leading bits more at each level, and the nodes among which the senders of the
    same leading bits are divided; one at the last level, so that it knows the sums."""

    bits: int
    chunks: list[int]

    @classmethod
    def of(cls, senders: int, fan_bits: int = FAN_BITS, slack: int = 4) -> Levels:
        bits = min(fan_bits, max(4, senders.bit_length()))
        chunks = []
        while senders > slack << bits:
            senders = -(-senders >> bits)
            chunks.append(senders)
        return cls(bits, [*chunks, 1])

    def deal(self, level: int, child: int, sums: list[np.ndarray]) -> list[tuple]:
        """Rows (node, child, False, data) that carry a sender's counts: sorted keys, fit and held of the pairs, and the
        same of the words."""
        shift = np.uint64(64 - self.bits * (level + 1))
        leading = [sums[i] >> shift for i in (0, 3)]
        paths = np.union1d(*leading)
        chunk = (child * 0x9E3779B97F4A7C15 >> 40) % self.chunks[level]
        (p, p_to), (w, w_to) = ((np.searchsorted(x, paths), np.searchsorted(x, paths, "right")) for x in leading)
        out = []
        for i, path in enumerate(paths.tolist()):
            pairs, words = slice(p[i], p_to[i]), slice(w[i], w_to[i])
            data = pack(_steps(sums[0][pairs]), _narrow(sums[1][pairs]), _narrow(sums[2][pairs]),
                        _steps(sums[3][words]), _narrow(sums[4][words]), _narrow(sums[5][words]))
            out.append((path * self.chunks[level] + chunk, child, False, data))
        return out


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max))


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and every value's number among them; frequent ones first."""
    distinct, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    order = _ranked(counts, np.arange(len(distinct)))
    number = np.empty(len(distinct), np.int64)
    number[order] = np.arange(len(order))
    return _narrow(distinct[order]), _narrow(number[inverse])


def _rows(rows: list[tuple], names: tuple[str, ...] = ("node", "child", "own", "data")) -> dict[str, pa.Array]:
    kinds = {"node": pa.int64(), "child": pa.int64(), "own": pa.bool_(), "data": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return {n: pa.array(c, kinds[n]) for n, c in zip(names, columns, strict=True)}


class _Sums:
    """What a node's senders dealt it, summed by key: ``sums`` as ``Levels.deal`` takes them."""

    def __init__(self, table: pa.Table):
        self.passing = [(r["child"], -1, True, r["data"]) for r in table.filter(table["own"]).to_pylist()]
        dealt = table.filter(pc.invert(table["own"]))
        self.children = dealt["child"].to_pylist()
        parts = [unpack(d) for d in dealt["data"].to_pylist()]
        self.sums: list[np.ndarray] = []
        self.numbers: list[list[np.ndarray]] = []
        for of in (0, 3):
            keys, numbers = _distinct(np.concatenate([np.zeros(0, np.uint64), *[np.cumsum(p[of], dtype=np.uint64) for p in parts]]))
            split = np.split(numbers, np.cumsum([len(p[of]) for p in parts])[:-1]) if parts else []
            self.sums.append(keys)
            self.numbers.append(split)
            for i in (1, 2):
                total = np.zeros(len(keys), np.int64)
                for number, p in zip(split, parts, strict=True):
                    total[number] += p[of + i].astype(np.int64)  # a sender's keys are distinct
                self.sums.append(total)

    def answers(self, node: int, counts: list[np.ndarray]) -> list[tuple]:
        """Rows (child, node, own, data): for each sender the counts (fit and held of pairs, and of words) of its keys,
        in their order."""
        of_pairs, of_words = counts[:2], counts[2:]
        return self.passing + [(child, node, False, pack(*(_narrow(c[p]) for c in of_pairs), *(_narrow(c[w]) for c in of_words)))
                               for child, p, w in zip(self.children, *self.numbers, strict=True)]

    def totals(self) -> bytes:
        """Distinct training words, training tokens and fit tokens among the node's words."""
        word = self.sums[3] != BEGINS
        fit, train = self.sums[4][word], (self.sums[4] + self.sums[5])[word]
        return pack(np.array([(train > 0).sum(), train.sum(), fit.sum()], np.uint64))


ANSWER = ("child", "node", "own", "data")
TOTALS = 1000  # groups to which the nodes' totals are dealt; their senders' numbers are negative


def _answered(table: pa.Table) -> list[np.ndarray]:
    """The counts of a sender's keys, in their order, from all nodes' answers to it."""
    order = np.argsort(table["node"].to_numpy(), kind="stable")  # by leading bits: a sender's nodes share the chunk
    parts = [unpack(table["data"][int(i)].as_py()) for i in order]
    return [np.concatenate([np.zeros(0, np.int64), *[p[i].astype(np.int64) for p in parts]]) for i in range(4)]


def answered(rows: DataFrame, levels: Levels, level: int = 0) -> DataFrame:
    """Answers (child, node, own, data) to the senders of the dealt rows, and the nodes' totals for the children
    below 0; ``own`` rows are handed through."""
    schema = "child long, node long, own boolean, data binary"
    if level + 1 == len(levels.chunks):
        def final(key: tuple, table: pa.Table) -> pa.Table:
            sums, node = _Sums(table), key[0].as_py()
            counts = [sums.sums[i] for i in (1, 2, 4, 5)]
            return pa.table(_rows([*sums.answers(node, counts), (-1 - node % TOTALS, node, False, sums.totals())], ANSWER))

        return rows.groupBy("node").applyInArrow(final, schema)

    rows = materialize(rows, "lm-dealt")

    def ahead(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table(_rows(levels.deal(level + 1, key[0].as_py(), _Sums(table).sums)))

    above = answered(rows.filter("not own").groupBy("node").applyInArrow(ahead, DEALT), levels, level + 1)
    above = materialize(above.withColumnRenamed("child", "at"), "lm-answers")

    def back(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        if not len(table):  # totals
            return found.select(["at", *ANSWER[1:]]).rename_columns(list(ANSWER))
        return pa.table(_rows(_Sums(table).answers(key[0].as_py(), _answered(found)), ANSWER))

    return rows.groupBy("node").cogroup(above.groupBy("at")).applyInArrow(back, schema)


def count_pairs(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, fan_bits: int = FAN_BITS, slack: int = 4) -> DataFrame:
    """The documents' tokens with all counts they need: rows of kind 1 hold a slice of a block (``data``), rows of
    kind 0 held-out counts n by context bucket a, rounded bigram estimate b and rounded word count c, and rows of kind 2
    totals (a: distinct training words, b: training tokens, c: fit tokens), to be summed."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    levels = Levels.of(max(1, -(-size // (TOKEN_BYTES * block_tokens))), fan_bits, slack)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, block_tokens):
            t, fold = Tokens.of(b), b.folds[b.docs]
            lengths = np.bincount(b.docs, minlength=len(b.rows))
            starts = np.cumsum(lengths) - lengths
            ids = np.array([0 if i is None else i for i in b.doc_ids], np.int64)
            own = pack(b.rows.astype(np.uint64), ids.view(np.uint64), np.array([i is None for i in b.doc_ids], np.uint8),
                       lengths.astype(np.uint32), t.contexts[starts].astype(np.uint32), _narrow(t.words),
                       np.frombuffer(b" ".join(t.vocabulary), np.uint8))
            (keys, numbers), (word_keys, of_word) = t.keys()
            sums = [keys, None, None, word_keys, None, None]
            begin = np.flatnonzero(t.contexts[starts] == len(t.vocabulary))  # a text's later blocks have another first context
            for i, x in enumerate((FIT, HELD), 1):
                at = np.flatnonzero(fold == x)
                sums[i] = np.bincount(numbers[at], minlength=len(keys))
                sums[3 + i] = np.bincount(of_word[t.words[at]], minlength=len(word_keys))
                sums[3 + i][of_word[-1]] += np.count_nonzero(b.folds[begin] == x)
            rows = levels.deal(0, b.number, sums)
            # The tokens go along to one of the nodes.
            rows.append((rows[b.number % len(rows)][0], b.number, True, own))
            yield pa.RecordBatch.from_pydict(_rows(rows))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        def out(kind: int, data: list[bytes | None], *columns: np.ndarray) -> pa.Table:
            n = len(data)
            return pa.table({"kind": pa.array(np.full(n, kind), pa.int32()), "data": pa.array(data, pa.binary()),
                             **{c: x.astype(np.int64) for c, x in zip("abcn", [*columns, *[np.zeros(n)] * (4 - len(columns))], strict=True)}})

        if key[0].as_py() < 0:
            totals = np.sum([unpack(d)[0] for d in table["data"].to_pylist()], axis=0)
            return out(2, [None], *totals[:, None])
        row, ids, none, lengths, firsts, words, vocabulary = unpack(table.filter(table["own"])["data"][0].as_py())
        fit, held, word_fit, word_held = _answered(table.filter(pc.invert(table["own"])))
        words, lengths = words.astype(np.int32), lengths.astype(np.int64)
        contexts = np.concatenate([np.zeros(1, np.int32), words[:-1]])
        contexts[np.cumsum(lengths) - lengths] = firsts
        t = Tokens(words, contexts, vocabulary.tobytes().split(b" "))  # no word holds a blank
        (_, numbers), (_, of_word) = t.keys()
        train, word_fit, word_train = fit + held, word_fit[of_word], (word_fit + word_held)[of_word]
        doc_ids = [None if no else i for i, no in zip(ids.view(np.int64).tolist(), none, strict=True)]
        docs_of = np.repeat(np.arange(len(row)), lengths)
        data = []
        for at in range(0, len(words), SLICE):
            to = slice(at, at + SLICE)
            part = docs_of[to]
            own = slice(part[0], part[-1] + 1)
            # A token's context is the token before it; only those of each document's first tokens are sent.
            lengths_in = np.bincount(part - part[0])
            of_first = word_train[contexts[to][np.cumsum(lengths_in) - lengths_in]]
            data.append(pack(row[own], ids[own], none[own], lengths_in.astype(np.uint32), _narrow(of_first),
                             _narrow(train[numbers[to]]), *_coded(word_train[words[to]])))
        # Held-out tokens by cell.
        at = np.flatnonzero(np.array([fold_of(i) for i in doc_ids])[docs_of] == HELD)
        of_context = word_fit[contexts[at]]
        bigram = np.divide(fit[numbers[at]], of_context, out=np.zeros(len(at)), where=of_context > 0)
        cells = np.stack([bucket(of_context), _cell(bigram), _count_cell(word_fit[words[at]])])
        cells, n = np.unique(cells, axis=1, return_counts=True)
        return pa.concat_tables([out(0, [None] * len(n), *cells, n), out(1, data)]).combine_chunks()

    answers = answered(docs.mapInArrow(deal, DEALT), levels)
    return materialize(answers.groupBy("child").applyInArrow(
        gather, "kind int, data binary, a long, b long, c long, n long"), "lm-counted")


@dataclass
class Totals:
    """Of the training documents: distinct words (with the end), tokens, and tokens of the fit part."""

    distinct: int
    train_tokens: int
    fit_tokens: int

    @classmethod
    def of(cls, counted: DataFrame) -> Totals:
        return cls(*(int(x or 0) for x in counted.filter("kind = 2").agg(F.sum("a"), F.sum("b"), F.sum("c")).first()))


def held_cells(counted: DataFrame, totals: Totals) -> pd.DataFrame:
    """Held-out counts by the context's bucket and the rounded estimates: bucket, bigram, word, n. Bounded by the grid."""
    cells = counted.filter("kind = 0").groupBy("a", "b", "c").agg(F.sum("n").alias("n")).toPandas()
    word = cells["c"].to_numpy()
    word = np.where(word > 0, 2.0 ** ((word - 1) / CELLS_PER_OCTAVE), 0.0) / max(totals.fit_tokens, 1)
    return pd.DataFrame({"bucket": cells["a"], "bigram": _estimate(cells["b"].to_numpy()), "word": word, "n": cells["n"]})


def _count_cell(count: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 plus the number of quarter octaves above 1."""
    return np.where(count > 0, 1 + np.round(CELLS_PER_OCTAVE * np.log2(np.maximum(count, 1))), 0).astype(np.int64)


def _cell(estimate: np.ndarray) -> np.ndarray:
    """0 for 0, else 1 plus the number of quarter octaves below 1."""
    return np.where(estimate > 0, 1 + np.round(-CELLS_PER_OCTAVE * np.log2(np.maximum(estimate, 1e-300))), 0).astype(np.int64)


def _estimate(cell: np.ndarray) -> np.ndarray:
    return np.where(cell > 0, 2.0 ** (-(cell - 1) / CELLS_PER_OCTAVE), 0.0)


def score(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, fan_bits: int = FAN_BITS, slack: int = 4) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Tokens are the words (A-Z lower-cased) and one end; the model learns from documents that are not held
    out, and every word in them is a context. Null and empty texts have the end alone. Repeated rows get equal
    scores; null ids count as the empty text in the split. Without training documents both scores rest on
    the uniform share alone. An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = count_pairs(rows, block_tokens, fan_bits, slack)
    totals = Totals.of(counted)
    weights = learn_weights(held_cells(counted, totals), totals.distinct)
    train_tokens, distinct = totals.train_tokens, totals.distinct

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                row, ids, none, lengths, firsts, pair, counts, word = unpack(data.as_py())
                docs_of, word = np.repeat(np.arange(len(row)), lengths), counts.astype(np.float64)[word]
                context = np.concatenate([[0.0], word[:-1]])
                context[np.cumsum(lengths) - lengths] = firsts
                base = np.log10((word + 0.5) / (train_tokens + 0.5 * (distinct + 1)))
                value = np.log10(weights.probability(pair.astype(np.float64), context, word, train_tokens, distinct))
                known, base, value = (np.bincount(docs_of, x, minlength=len(row)) for x in (word > 0, base, value))
                yield pa.RecordBatch.from_pydict({
                    "row": row.view(np.int64), "doc_id": pa.array(ids.view(np.int64), mask=none.astype(bool)),
                    "n_tokens": lengths.astype(np.int64), "n_known": known.astype(np.int64), "base_score": base, "score": value})

    sums = counted.filter("kind = 1").select("data").mapInArrow(
        finish, "row long, doc_id long, n_tokens long, n_known long, base_score double, score double")
    # A text may be cut into several slices.
    whole = sums.groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", (crc_of_id(F.col("doc_id")) % 5 == 1).alias("held_out"), "n_tokens", "n_known",
                        F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")

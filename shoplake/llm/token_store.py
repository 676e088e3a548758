"""Token ids of documents in Parquet list columns.

Documents are range-sorted by doc_id and encoded with a public tokenizer file. Each file holds one range:
doc_id, part (number of the range), local_start (ids before the document in its range), n_tokens and ids.
The ids are delta- or dictionary-encoded; row groups and pages are kept small, and Spark writes page
indexes, so that a reader can fetch a few documents, or only the numbers, without the rest.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
MEMO_MATCHES = 800_000  # what a task remembers; it then starts anew
MEMO_LENGTH = 64
BATCH_BYTES = 8 << 20  # texts that are encoded together
PIECE_BYTES = 4 << 20  # texts are cut into matches in pieces of about this size

# The byte-level tokenizer encodes the matches of its pattern one by one, so equal matches need encoding once: those of
# a batch are found together, and each distinct one is looked up. Fixed value of the tokenizer: its pattern,
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# Its classes, which all bytes of a character get:
_SIGN, _LETTER, _NUMBER, _BLANK, _BREAK, _UNSURE = range(6)
# Characters whose class is the same in every version of Unicode's tables: ASCII but for separators, Latin, Greek,
# Cyrillic, general punctuation, kana, common ideographs, Hangul. A text with others goes to the tokenizer whole.
_SURE = ((0x20, 0x7E), (0xA1, 0x17F), (0x388, 0x38A), (0x38E, 0x3A1), (0x3A3, 0x3CE), (0x400, 0x481), (0x2010, 0x2027),
         (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))


def _class_table() -> np.ndarray:
    """Classes of the characters up to U+FFFF."""
    table = np.full(1 << 16, _UNSURE, np.uint8)
    for first, last in _SURE:
        table[first:last + 1] = [{"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _SIGN)
                                 for c in range(first, last + 1)]
    table[[9, 10, 13]] = _BREAK
    table[0x20] = _BLANK
    return table


_CLASSES = _class_table()
# Whether a byte starts a run after a byte of another class (row), and whether it is the last of white space before a
# byte of another class (column).
_STARTS_RUN = np.array([[p != c and p != _BLANK if c < _BLANK else p < _BLANK for c in range(6)] for p in range(6)])
_LAST_SPACE = np.array([[p in (_BLANK, _BREAK) and c not in (_BLANK, _BREAK) for c in range(6)] for p in range(6)])


def _classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 ``data`` belongs to."""
    found = _CLASSES[:256][data]
    for begin in range(0, len(data), PIECE_BYTES):
        lead = np.flatnonzero(data[begin:begin + PIECE_BYTES] >= 0xC0) + begin
        length = 1 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)  # bytes that follow
        for more in (1, 2, 3):
            at = lead[length == more]
            if more == 3:
                kinds = np.full(len(at), _UNSURE, np.uint8)
            else:
                code = data[at].astype(np.int32) & (0x3F >> more)
                for k in range(1, more + 1):
                    code = code << 6 | data[at + k] & 0x3F
                kinds = _CLASSES[code]
            for k in range(more + 1):
                found[at + k] = kinds
    return found


def _match_starts(data: np.ndarray, classes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the pattern's matches start in texts that lie one after the other and start at ``texts``."""
    size = len(data)
    texts = texts[texts < size]
    pair = classes[:-1] * np.uint8(6) + classes[1:]
    start = np.ones(size, bool)
    # A run of one class is a match, with the blank before it; of white space before something else the last is apart.
    start[1:] = _STARTS_RUN.ravel()[pair]
    inner = start.copy()
    start[:-1] |= _LAST_SPACE.ravel()[pair]
    text_start = np.zeros(size + 2, bool)
    text_start[texts] = True
    ends = texts[texts > 0] - 1
    start[ends] = inner[ends]  # white space at a text's end is one match
    start[texts] = True
    # An apostrophe that starts a match takes s, t, m, d, re, ve or ll with it if it is the only sign before letters.
    at = np.flatnonzero(data == ord("'"))
    at = at[start[at]]
    after = np.r_[data, 0, 0]
    one, two = after[at + 1], after[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & ~text_start[at + 1]
    long = np.isin(one.astype(np.int64) * 256 + two, [x * 256 + y for x, y in (b"re", b"ve", b"ll")])
    long &= ~text_start[at + 1] & ~text_start[at + 2]
    start = np.r_[start, False, False, False, False]
    start[at[short | long] + 1] = False
    start[at[short] + 2] = True
    start[at[long] + 3] = True
    return np.flatnonzero(start[:size])


def _byte_characters() -> dict[int, str]:
    """The characters by which byte-level vocabularies write the bytes: visible ones stand for themselves, the
    others follow from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class _Matches(dict):
    """Ids of the pattern's matches as unsigned 32-bit integers, encoded by the tokenizer's model when first asked for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.characters = _byte_characters()
        self.blank = self.characters[0x20]

    def __missing__(self, match: str) -> bytes:
        if match.isascii() and match.isprintable():
            written = match.replace(" ", self.blank)
        else:
            written = match.encode().decode("latin-1").translate(self.characters)
        found = array("I", [t.id for t in self.tokenize(written)]).tobytes()
        if len(match) <= MEMO_LENGTH and len(self) < MEMO_MATCHES:
            self[match] = found
        return found


class Encoder:
    """Encodes texts with a tokenizers file; created in each task."""

    def __init__(self, path: str):
        self.matches = _Matches(path)
        # Strings that are tokens by themselves, such as <|endoftext|>: a text with one goes to the tokenizer whole.
        self.added = [t.content for t in self.matches.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        """Ids of a text as unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.large_string()))[0].as_py()

    def encode_all(self, texts: pa.Array) -> pa.LargeBinaryArray:
        """Ids of each text as unsigned 32-bit integers; null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts.validate(full=True)
        data, ends = _flat(texts)
        classes = _classes(data)
        unsure = np.zeros(len(texts), bool)
        unsure[np.searchsorted(ends, np.flatnonzero(classes == _UNSURE), "right") - 1] = True
        joined = data.tobytes()
        for token in self.added:
            if token.encode() in joined:
                unsure |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not unsure.any():
            return self._by_matches(data, classes, ends)
        mask = pa.array(unsure)
        whole = [array("I", self.matches.tokenizer.encode(t, add_special_tokens=False).ids).tobytes()
                 for t in texts.filter(mask).to_pylist()]
        data, ends = _flat(pc.if_else(mask, pa.scalar("", pa.large_string()), texts))
        rest = self._by_matches(data, _classes(data), ends)
        return pc.replace_with_mask(rest, mask, pa.array(whole, pa.large_binary()))

    def _by_matches(self, data: np.ndarray, classes: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
        """Ids of the texts between ``ends`` in ``data``."""
        ids: list[np.ndarray] = []
        places, sizes, before = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        matches = self.matches
        for low, high in _pieces(classes, ends):
            if len(matches) >= MEMO_MATCHES:
                matches.clear()
            inside = ends[np.searchsorted(ends, low):np.searchsorted(ends, high)] - low
            starts = _match_starts(data[low:high], classes[low:high], np.r_[0, inside])
            strings = pa.LargeStringArray.from_buffers(
                len(starts), pa.py_buffer(np.r_[starts, high - low]), pa.py_buffer(data[low:high])).dictionary_encode()
            known = list(map(matches.__getitem__, strings.dictionary.to_numpy(zero_copy_only=False)))
            taken = pa.array(known, pa.large_binary()).take(strings.indices)
            found, found_ends = _flat(taken)
            ids.append(found)
            places.append(starts + low)
            sizes.append(found_ends[:-1] + before)
            before += len(found)
        offsets = np.r_[np.concatenate(sizes), before][np.searchsorted(np.concatenate(places), ends)]
        together = np.concatenate([np.zeros(0, np.uint8), *ids])
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(together)])


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings or binaries one after the other, and where each starts, and the end."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def _pieces(classes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut texts into pieces of about PIECE_BYTES, between texts or, inside a long one, before a blank between other
    characters, where no match reaches across."""
    low, size = 0, len(classes)
    while low < size:
        high = min(low + PIECE_BYTES, size)
        if high < size:
            text = int(ends[np.searchsorted(ends, high, "right") - 1])
            if text > low:
                high = text
            else:
                text = int(ends[np.searchsorted(ends, high)])
                # Look on in steps, for most texts have a blank near by.
                while high < text:
                    near = classes[high - 1:min(high + PIECE_BYTES, text)]
                    cut = np.flatnonzero((near[1:-1] == _BLANK) & (near[:-2] < _BLANK) & (near[2:] < _BLANK))
                    if len(cut):
                        high += int(cut[0])
                        break
                    high = min(high + PIECE_BYTES, text)
        yield low, high
        low = high


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, so that tasks of one worker share what was learnt."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, encoding: str = "delta",
          row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizer file, add ``end_id`` to each, write them by doc_id.

    Null texts are empty and have the end id alone. Null ids come first; rows with the same id are ordered
    by a hash of the text. An empty table writes an empty file. Other columns are ignored.
    """
    if encoding not in ("delta", "dictionary"):
        raise ValueError(f"unknown encoding {encoding!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(upto // BATCH_BYTES)) + 1).tolist(), len(upto)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                ids, ends = _flat(encoder(tokenizer).encode_all(batch.column(1).slice(low, high - low)))
                values = np.insert(ids.view("<i4"), ends[1:] // 4, end_id)
                ends = ends // 4 + np.arange(len(ends))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(np.full(high - low, part), pa.int32()),
                     pa.array(before + ends[:-1]), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"])
                before += int(ends[-1])

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h")
               .sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text"))
    encoded = ordered.mapInArrow(run, "doc_id long, part int, local_start long, n_tokens long, ids array<int>")
    (encoded.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .parquet(path))


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens, read without the ids."""
    return read(spark, path).drop("ids")


def read(spark: SparkSession, path: str, doc_ids: Column | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids of the stored documents, or of those that ``doc_ids``, a condition on the
    column doc_id, selects; the condition reaches the row groups and pages."""
    stored = spark.read.parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    wanted = stored.filter(doc_ids) if doc_ids is not None else stored
    return wanted.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def crc_of_ids(ids: Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            ends = (4 * lists.offsets.to_numpy().astype(np.int64)).tolist()
            yield pa.array([zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.int64())

    return of(ids)

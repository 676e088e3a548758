"""Fill-in-the-middle transformation: a text's prefix, middle and suffix, cut at unit ends and reordered.

The cuts are found in the UTF-8 bytes without decoding or splitting: a batch's text buffer is viewed as
64-bit words, the bytes that end a unit are marked arithmetically in all eight bytes of a word at once,
and the marks are counted per word. A unit's end is then a binary search in the running counts followed
by a select inside one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

UNITS = ("line", "char")
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_NEWLINES = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE = np.uint64(1)


def _words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian words, zeros after the last, with one whole word of zeros at the end."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def newline_marks(data: np.ndarray) -> np.ndarray:
    """Words with the top bit set in every byte that is a line feed."""
    x = _words(data) ^ _NEWLINES
    # The sum carries into a byte's top bit unless its low seven bits are zero; no carry leaves the byte.
    return ~(((x & _LOW7) + _LOW7) | x | _LOW7)


def start_marks(data: np.ndarray) -> np.ndarray:
    """Words with the top bit set in every byte that begins a character (also in the zeros after the last)."""
    w = _words(data)
    return _HIGH & ~(w & ~(w << _ONE))  # 10xxxxxx continues a character


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.words = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each place."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((_ONE << bits) - _ONE))

    def select(self, number: np.ndarray) -> np.ndarray:
        """Place of the marked byte with each number, counted from 0."""
        word = np.searchsorted(self.before, number, side="right") - 1
        left, skip = self.words[word], number - self.before[word]
        for done in range(7):
            left = np.where(skip > done, left & (left - _ONE), left)
        lowest = left & (~left + _ONE)
        return (word << 3) + (np.bitwise_count(lowest - _ONE) >> 3)


def cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, draws: tuple[np.ndarray, np.ndarray],
         unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text ``data[start:end]``, and where the units before its two cuts end (bytes, ascending).

    A draw modulo (units + 1) is the number of units before a cut.
    """
    # A byte ends a character if the next one begins one.
    marks = Marks(newline_marks(data) if unit == "line" else start_marks(data[1:]))
    first, total = marks.rank(starts), marks.rank(ends)
    # A text that does not stop on a mark has one unit more.
    whole = np.zeros(len(starts), np.int64)
    some = np.flatnonzero(ends > starts)
    whole[some] = marks.rank(ends[some]) - marks.rank(ends[some] - 1)
    n = total - first + ((ends > starts) & (whole == 0))
    places = []
    a, b = (d % (n + 1) for d in draws)
    for units in (np.minimum(a, b), np.maximum(a, b)):
        at = np.where(units == n, ends, starts)
        inside = np.flatnonzero((units > 0) & (units < n))
        at[inside] = marks.select(first[inside] + units[inside] - 1) + 1
        places.append(at)
    return n, *places


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without nulls."""
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def transform(docs: DataFrame, unit: str = "line", key: str = "7", rate: int = 100, spm_share: int = 50) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output of every row.

    Four numbers come from the SHA-256 of ``key:doc_id``: two cuts between the units, whether the text is
    transformed (``rate`` of 100) and its form (``spm_share`` of 100 spm, the rest psm). A text that is
    empty, or holds one of the markers, stays plain, and its chars are null. Units are lines (with their
    line feed) or characters. Null texts are empty; a null id counts as the empty text. Repeated rows get
    equal results, however long a text is it is cut whole; an empty table gives an empty result; other
    columns are ignored.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    doc_id = F.col("doc_id")
    digest = F.sha2(F.concat(F.lit(f"{key}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    text = F.coalesce("text", F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    rows = docs.select(doc_id.cast("long").alias("doc_id"), text.alias("text"), digest.alias("d")).select(
        "doc_id", "text", *[F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    rows = rows.withColumn("form", F.when((text == "") | marked | (F.col("h3") % 100 >= rate), PLAIN)
                           .when(F.col("h4") % 100 < spm_share, SPM).otherwise(PSM))
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = _buffers(batch.column("text"))
            starts, ends = offsets[:-1], offsets[1:]
            draws = tuple(batch.column(h).to_numpy(zero_copy_only=False) for h in ("h1", "h2"))
            n, one, two = cuts(data, starts, ends, draws, unit)
            chars = Marks(start_marks(data))
            whole, form = memoryview(data), batch.column("form").to_pylist()
            pieces: list[bytes | memoryview] = []
            for f, a, x, y, b in zip(form, starts, one, two, ends, strict=True):
                if f == PLAIN:
                    pieces.append(whole[a:b])
                elif f == PSM:
                    pieces += [p, whole[a:x], s, whole[y:b], m, whole[x:y]]
                else:
                    pieces += [s, whole[y:b], p, whole[a:x], m, whole[x:y]]
            plain = np.array([f == PLAIN for f in form], bool)
            sizes = np.r_[0, np.cumsum(ends - starts + np.where(plain, 0, len(p + s + m)))]
            output = pa.LargeStringArray.from_buffers(len(form), pa.py_buffer(sizes.astype(np.int64)),
                                                      pa.py_buffer(b"".join(pieces)))
            spans = [pa.array(chars.rank(to) - chars.rank(of), pa.int64(), mask=plain) for of, to in ((starts, one), (one, two))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), batch.column("form"), *spans, pc.cast(output, pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made from."""
    def after(marker: str, of: Column) -> Column:
        return F.split_part(of, F.lit(marker), F.lit(2))

    def until(marker: str, of: Column) -> Column:
        return F.split_part(of, F.lit(marker), F.lit(1))

    psm = F.concat(until(SUFFIX, after(PREFIX, output)), after(MIDDLE, output), until(MIDDLE, after(SUFFIX, output)))
    spm = F.concat(until(MIDDLE, after(PREFIX, output)), after(MIDDLE, output), until(PREFIX, after(SUFFIX, output)))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)

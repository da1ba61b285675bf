"""Fill-in-middle documents (operator 11): unit boundaries found in 64-bit words of the UTF-8 text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .textkit import Texts, slices

#: fixed values: the markers, and shares of a hundred
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED_OF_100 = 90
SUFFIX_FIRST_OF_100 = 20

_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONES = np.uint64(0x0101010101010101)
_CASE = np.uint64(0x2020202020202020)
_TOP = np.uint64(56)

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Units:
    """Unit ends of all texts of a slice. Each text begins on a word and is followed by a zero byte at least.

    A word holds eight bytes, lowest first; a mark is the high bit of a byte.
    """

    def __init__(self, texts: Texts):
        sizes = texts.ends - texts.starts
        words = sizes // 8 + 1
        self.first = np.cumsum(words) - words
        data = np.zeros(8 * int(words.sum()), np.uint8)
        moved = np.repeat(8 * self.first - texts.starts, sizes)
        inside = texts.data[texts.starts[0] : texts.ends[-1]] if texts.count else texts.data[:0]
        data[np.arange(len(inside)) + moved] = inside
        self.data = data
        w = data.view("<u8")
        letters = self._letters(w)
        follows = w & ~(w << np.uint64(1)) & _HIGH  # bytes 10xxxxxx, which go on with a code point
        ends = _HIGH & ~(self._next(follows) | (letters & self._next(letters)))
        past = np.uint64(8) * (sizes % 8).astype(np.uint64)
        ends[self.first + words - 1] &= (np.uint64(1) << past) - np.uint64(1)  # not the zero bytes
        self.ends, self.leads = ends, _HIGH & ~follows
        self.up_to = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
        self.leads_up_to = np.cumsum(np.bitwise_count(self.leads), dtype=np.int64)
        before = np.concatenate([[0], self.up_to])
        self.before = before[self.first]
        self.count = before[self.first + words] - self.before

    @staticmethod
    def _letters(w: np.ndarray) -> np.ndarray:
        """Marks bytes A-Z and a-z: no carry leaves a byte, as only seven bits are added to."""
        low = (w | _CASE) & _LOW
        from_a = low + np.uint64(0x80 - 0x61) * _ONES
        past_z = low + np.uint64(0x80 - 0x7B) * _ONES
        return from_a & ~past_z & ~w & _HIGH

    @staticmethod
    def _next(marks: np.ndarray) -> np.ndarray:
        """Marks of the byte that follows, also across words."""
        out = marks >> np.uint64(8)
        out[:-1] |= marks[1:] << _TOP
        return out

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Byte, from the text's own begin, after so many units of each text."""
        wanted = self.before + units
        word = np.minimum(np.searchsorted(self.up_to, wanted, side="left"), max(0, len(self.up_to) - 1))
        marks = self.ends[word]
        rank = (wanted - self.up_to[word] + np.bitwise_count(marks)).astype(np.uint64)
        running = (marks >> np.uint64(7)) * _ONES  # byte k: marks in bytes 0 to k
        reached = ((running | _HIGH) - rank * _ONES) & _HIGH
        at = 8 * (word - self.first) + 9 - np.bitwise_count(reached)
        return np.where(units == 0, 0, at)

    def chars(self, cut: np.ndarray) -> np.ndarray:
        """Code points before a byte of each text."""
        word = self.first + cut // 8
        part = (np.uint64(1) << (np.uint64(8) * (cut % 8).astype(np.uint64))) - np.uint64(1)
        whole = np.concatenate([[0], self.leads_up_to])
        return whole[word] - whole[self.first] + np.bitwise_count(self.leads[word] & part)


def _arranged(part: pa.RecordBatch) -> pa.RecordBatch:
    texts = Texts(part.column("text"))
    units = Units(texts)
    h1, h2, h3, h4 = (part.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5))
    lo, hi = np.minimum(h1 % (units.count + 1), h2 % (units.count + 1)), np.maximum(h1 % (units.count + 1), h2 % (units.count + 1))
    a, b = units.cut(lo), units.cut(hi)
    upto_a, upto_b = units.chars(a), units.chars(b)
    raw = texts.data.tobytes()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    forms, outputs = [], []
    for k, (start, end, x, y) in enumerate(zip(texts.starts.tolist(), texts.ends.tolist(), a.tolist(), b.tolist())):
        text = raw[start:end]
        if not text or h3[k] % 100 >= CHANGED_OF_100 or any(mark in text for mark in marks):
            form, out = "plain", text
        elif h4[k] % 100 < SUFFIX_FIRST_OF_100:
            form, out = "spm", s + text[y:] + p + text[:x] + m + text[x:y]
        else:
            form, out = "psm", p + text[:x] + s + text[y:] + m + text[x:y]
        forms.append(form)
        outputs.append(out)
    plain = np.array([f == "plain" for f in forms], bool)
    return pa.record_batch({
        "doc_id": part.column("doc_id"), "n": pa.array(units.count, pa.int64()), "form": pa.array(forms, pa.string()),
        "prefix_chars": pa.array(upto_a.astype(np.int64), mask=plain),
        "middle_chars": pa.array((upto_b - upto_a).astype(np.int64), mask=plain),
        "output": pa.array(outputs, pa.binary()).cast(pa.string()),
    })


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", epoch: int = 1) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output (text).

    A unit is a run of ASCII letters or any other code point. Two cuts, drawn from the
    sha256 of ``epoch:doc_id``, part a text into prefix, middle and suffix; ``psm`` puts the
    suffix before the middle, ``spm`` before the prefix as well, ``plain`` leaves the text.
    Another epoch draws other cuts. No shuffle: each row is settled where it is read.

    Null and empty texts are plain and empty, n is 0. Texts that hold a marker are plain.
    A null id is hashed as an empty one. Repeated rows give equal rows; an empty table
    none. Other columns of ``docs`` are not read. A very long text needs some 20 bytes of
    memory per byte of it.
    """
    digest = F.sha2(F.concat(F.lit(f"{epoch}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        "doc_id", "text", *(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _arranged(part)

    return rows.mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The original text, from an output and its form alone.

    Markers are told for certain: no text that holds one is rearranged, and none can
    arise where a part meets a marker, as they neither begin with what they end with nor
    the other way round.
    """
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    psm = F.split(body, f"{SUFFIX}|{MIDDLE}", -1)
    spm = F.split(body, f"{PREFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )


def fill_digests(docs: DataFrame) -> DataFrame:
    """The operator's rows with digests of output and of the text restored from it, in place of the output."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))

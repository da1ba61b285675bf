"""Whole texts as numpy arrays inside Arrow tasks: words, lines, and hashes of spans.

Every helper works on a slice of an Arrow batch, cut so that the texts in it hold a few
megabytes; a single longer text forms a slice of its own. Nulls count as empty texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 1 << 20

#: bytes of [\x20\x09-\x0D]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: bytes that begin a code point in UTF-8
IS_LEAD = (np.arange(256) & 0xC0) != 0x80
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of hashes and their low bits are usable."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class SpanHash:
    """64-bit hash of any span of a byte array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _grown(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        v = _BYTE[data]
        v *= self.up[: len(data)]
        np.cumsum(v, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = self.sums[ends]
        h -= self.sums[starts]
        h *= self.down[starts]
        h += (ends - starts).astype(np.uint64)
        return mix(h)

    def windows(self, width: int) -> np.ndarray:
        """Of every window of so many bytes, by its start."""
        n = max(0, len(self.sums) - width)
        h = self.sums[width:][:n] - self.sums[:n]
        h *= self.down[:n]
        return mix(h)


class Texts:
    """A slice: all texts in one byte array, text i at ``starts[i]:ends[i]``."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        at = bounds[0] if len(column) else 0
        end = bounds[-1] if len(column) else 0
        self.data = np.frombuffer(raw, np.uint8)[at:end] if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.column = column
        self.starts, self.ends = bounds[:-1] - at, bounds[1:] - at
        self.count = len(column)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every word ``[^\\x20\\x09-\\x0D]+``."""
        space = IS_SPACE[self.data]
        edge = np.zeros(len(space) + 1, bool)
        edge[self.starts] = True
        edge[self.ends] = True
        begins = ~space
        begins[1:] &= space[:-1] | edge[1:-1]
        stops = ~space
        stops[:-1] &= space[1:] | edge[1:-1]
        s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        return s, e, np.searchsorted(self.ends, s, side="right")

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of every line (``\\n`` apart; each text has one at least)."""
        cut = np.flatnonzero(self.data == 10)
        doc = np.searchsorted(self.ends, cut, side="right")
        starts = np.concatenate([self.starts, cut + 1])
        docs = np.concatenate([np.arange(self.count), doc])
        order = np.lexsort((starts, docs))
        starts, docs = starts[order], docs[order]
        last = np.ones(len(docs), bool)
        last[:-1] = docs[1:] != docs[:-1]
        ends = np.empty(len(docs), np.int64)
        ends[:-1] = starts[1:] - 1
        ends[last] = self.ends[docs[last]]
        return starts, ends, docs


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES,
           rows: int = 1 << 13) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with texts of about ``limit`` bytes together, and at most so many rows."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = total[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(total, done + limit, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def zipped(docs: DataFrame) -> DataFrame:
    """doc_id and z: each text compressed by itself, for shuffles of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch):
                z = [press.compress((t or "").encode()) for t in part.column("text").to_pylist()]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "z": pa.array(z, pa.binary())})

    return whole_texts(docs).mapInArrow(run, "doc_id long, z binary")


def unzipped(column: pa.Array) -> pa.Array:
    """The texts of a column that ``zipped`` made."""
    press = zstandard.ZstdDecompressor()
    return pa.array([press.decompress(z) for z in column.to_pylist()], pa.binary()).cast(pa.string())


def small_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Has Spark send texts to Python tasks in Arrow batches of a few megabytes, not 64, in this session.

    Both sides of a task hold whole batches, so that these decide its memory more than the
    operators do. A smaller setting of the session stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(name).lower()).groups()
    now = int(size) << 10 * " kmgt".index(unit or " ")
    if not 0 < now <= limit:
        spark.conf.set(name, f"{limit}b")


def per_text(counts: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """Sum of counts by text number."""
    return np.bincount(docs, weights=counts, minlength=n).astype(np.int64)


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text: other columns, of any name, stay out of the way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def is_held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Chars:
    """Lower-cased code points of a slice; blanks are spaces, and each text stands between two."""

    def __init__(self, column: pa.Array):
        texts = [(t or "").lower() for t in column.to_pylist()]
        self.count = len(texts)
        joined = "".join(f" {t} \0" for t in texts)
        self.codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).copy()
        self.codes[(self.codes <= 32) & (self.codes > 0)] = 32
        sizes = np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def grams(self, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hashed bin of every n-gram within a text."""
        m = len(self.codes) - n + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        h = np.full(m, n, np.uint32)
        inside = np.ones(m, bool)
        for k in range(n):
            part = self.codes[k : k + m]
            h *= np.uint32(0x9E3779B1)
            h += part
            inside &= part != 0
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        h >>= np.uint32(32 - bits)
        at = np.flatnonzero(inside)
        return at, h[at]


def few_by_hash(rows: DataFrame, count: int, bound: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``bound`` of the ``count`` rows, chosen by a hash of the id.

    A threshold on the hash leaves about twice as many as are wanted, so that what is
    ordered for the exact bound does not grow with the table.
    """
    share = min(1.0, 2.0 * bound / max(1, count) + 64.0 / max(1, count))
    mark = F.pmod(F.xxhash64(id_col), F.lit(1 << 40))
    return rows.filter(mark <= int(share * (1 << 40))).orderBy(F.xxhash64(id_col), id_col).limit(bound)


def label_counts(labels: DataFrame, label: str) -> dict[int, int]:
    """Number of labelled rows outside the held-out ones, by label value."""
    got = (
        labels.filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id").cast("long")))
        .groupBy(F.col(label).cast("int").alias("label")).count().filter("label in (0, 1)").collect()
    )
    return {r["label"]: r["count"] for r in got}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, totals: dict[int, int]) -> DataFrame:
    """At most ``bound`` labelled texts of each label value 0 and 1 outside the held-out rows: doc_id, text, label.

    ``totals`` are the label counts. Only ids and labels are ordered; the chosen ones
    (bounded, hence broadcast) then pick their texts from one scan of the documents.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & ~is_held_out())
    )
    parts = [few_by_hash(known.filter(F.col("label") == v), totals.get(v, 0), bound) for v in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    return whole_texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised logistic regression, by accelerated gradient steps."""
    n, d = x.shape
    weight = weight / weight.sum()
    beta, bias = np.zeros(d), 0.0
    mb, mc = beta.copy(), bias
    x = np.ascontiguousarray(x, np.float64)
    top = 0.25 * float(weight @ np.einsum("ij,ij->i", x, x)) + 0.25 + l2
    # the largest eigenvalue bounds the curvature; a few power steps find it
    v = np.ones(d) / max(1.0, np.sqrt(d))
    for _ in range(20 if d else 0):
        u = x.T @ (weight * (x @ v))
        norm = float(np.linalg.norm(u))
        if norm == 0:
            break
        v = u / norm
        top = min(top, 0.25 * (1.5 * norm + 1.0) + l2)
    for k in range(steps):
        err = weight * (logistic(x @ mb + mc) - y)
        nb, nc = mb - (x.T @ err + l2 * mb) / top, mc - err.sum() / top
        t = k / (k + 3.0)
        mb, mc = nb + t * (nb - beta), nc + t * (nc - bias)
        beta, bias = nb, nc
    return beta, float(bias)

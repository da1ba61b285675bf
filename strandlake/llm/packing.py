"""Packing of tokenised documents into sequences by vector best-fit (operator 3)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .textkit import IS_SPACE, SpanHash, Texts, slices, whole_texts

VOCABULARY = "byte_bpe_50k.json"
SEQUENCE = 1024
END_ID = 2
#: pieces that one best-fit run sees; the waste of a run is a few open sequences at its end
RUN_PIECES = 16384
#: documents of such a run where sequences follow the order of the table; it is how far a piece moves
ORDERED_RUN = 2048
#: a worker remembers the ids of distinct chunks of text up to so many bytes of chunks
CACHE_BYTES = 8 << 20
#: bytes of text that are encoded together, about
SLICE = 1 << 19

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: bits of a sequence's number for the piece; a text has fewer than 2**31 bytes
PIECE_BITS = 22


_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
_MARK = np.array([32 < b < 127 and not _ALNUM[b] for b in range(256)])


def _safe_cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where a text may be cut without a change to its ids: each text's start, before
    every blank that follows a character that is not blank, and between an ASCII letter or
    digit and an ASCII mark after it.

    The vocabulary splits a text before it merges bytes, and no part of that split goes
    over such a place. Blanks outside ASCII may stand before; a byte that may end one
    (after 0xC2, or two after 0xE1-0xE3) allows no cut.
    """
    space = IS_SPACE[data]
    odd = space | ((data >= 0x1C) & (data <= 0x1F))
    high = data >= 0x80
    odd[1:] |= high[1:] & (data[:-1] == 0xC2)
    odd[2:] |= high[2:] & (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)
    cut = np.zeros(len(data), bool)
    cut[1:] = (space[1:] & ~odd[:-1]) | (_MARK[data[1:]] & _ALNUM[data[:-1]])
    cut[starts[starts < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of whole texts. Each distinct chunk between safe cuts is encoded once and remembered."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.id_bytes = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.id_bytes[i] = len(name)  # one character of a name stands for one byte
        self.reset()

    def reset(self) -> None:
        self.keys, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.bytes = np.zeros(0, np.uint32), 0

    def _learn(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        # chunks of one space and no other blank can stand behind each other: encoded as one text
        space = np.concatenate([[0], np.cumsum(IS_SPACE[data])])
        plain = (data[begin] == 32) & (space[end] - space[begin] == 1)
        raw = data.tobytes()
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        keys, begin, end = keys[order], begin[order], end[order]
        n = int(plain.sum())
        joined = b"".join([raw[a:b] for a, b in zip(begin[:n].tolist(), end[:n].tolist())]).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids if n else [], np.uint32)
        at = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum((end - begin)[:n]))
        size = np.diff(np.concatenate([[-1], at]))
        others = [raw[a:b].decode() for a, b in zip(begin[n:].tolist(), end[n:].tolist())]
        got = [x.ids for x in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)] if others else []
        size = np.concatenate([size, np.fromiter(map(len, got), np.int64, len(got))]).astype(np.int64)
        more = np.fromiter(chain.from_iterable(got), np.uint32)
        first = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, ids, more])
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.first = np.insert(self.first, at, first[order])
        self.size = np.insert(self.size, at, size[order])
        self.bytes += int((end - begin).sum())

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and how many each text has."""
        if not len(texts.data):
            return np.zeros(0, np.uint32), np.zeros(texts.count, np.int64)
        if self.bytes > CACHE_BYTES:
            self.reset()
        begin = _safe_cuts(texts.data, texts.starts)
        end = np.append(begin[1:], len(texts.data))
        keys, where, back = np.unique(SpanHash(texts.data).of(begin, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = where[~known]
            self._learn(keys[~known], texts.data, begin[new], end[new])
            at = np.searchsorted(self.keys, keys)
        first, size = self.first[at][back].astype(np.int64), self.size[at][back].astype(np.int64)
        total = np.cumsum(size)
        ids = self.ids[np.arange(int(total[-1])) + np.repeat(first - (total - size), size)]
        doc = np.searchsorted(texts.ends, begin, side="right")
        return ids, np.bincount(doc, weights=size, minlength=texts.count).astype(np.int64)


_encoders: dict[str, Encoder] = {}


def encoder_for(vocabulary: str) -> Encoder:
    """This process's encoder; a worker that runs several tasks keeps what it has learned."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def cut_lengths(length: int, sequence: int) -> list[int]:
    """Lengths of a document's pieces: full ones, and before them what is left over."""
    head = length % sequence
    return ([head] if head else []) + [sequence] * (length // sequence)


def _with_stand(docs: DataFrame) -> DataFrame:
    """doc_id, text, and where the row stands: in which part of the table, and its number there.

    Parts of a stored table are its files in order of their names, whatever order they are
    read in; those of any other table are its partitions.
    """
    try:
        stand = docs.select("*", F.col("_metadata.file_path").alias("_part"), F.col("_metadata.row_index").alias("_number"))
    except AnalysisException:  # not read from files
        number = F.monotonically_increasing_id()
        stand = docs.select("*", F.format_string("%010d", F.shiftright(number, 33)).alias("_part"),
                            number.bitwiseAND(F.lit((1 << 33) - 1)).alias("_number"))
    return stand.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "_part", "_number")


def pieces(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end_id: int = END_ID, in_order: bool = False) -> DataFrame:
    """Pieces of all documents with the crc32 of their ids (unsigned 32-bit little-endian), and
    with ``in_order`` the place of the document in the table."""
    rows, first = whole_texts(docs), {}
    if in_order:
        rows = _with_stand(docs)
        sizes = sorted((r["_part"], r["count"]) for r in rows.groupBy("_part").count().collect())
        first = dict(zip([p for p, _ in sizes], accumulate((n for _, n in sizes), initial=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocabulary)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                texts = Texts(part.column("text"))
                ids, counts = encoder.encode(texts)
                rows: list[tuple] = []
                at = 0
                places = part.column("doc_id").to_pylist()  # not used unless in_order
                if in_order:
                    places = [first[p] + k for p, k in zip(part.column("_part").to_pylist(), part.column("_number").to_pylist())]
                for doc_id, place, n in zip(part.column("doc_id").to_pylist(), places, counts.tolist()):
                    own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    start = 0
                    for k, size in enumerate(cut_lengths(n + 1, sequence)):
                        rows.append((doc_id, k, start, size, zlib.crc32(own[start : start + size]), place))
                        start += size
                columns = list(zip(*rows)) if rows else [()] * 6
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "place"]
                keep = len(names) if in_order else len(names) - 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)][:keep], names[:keep])

    return rows.mapInArrow(run, PIECES + ", place long" * in_order)


def best_fit(lengths: np.ndarray, capacity: np.ndarray, rule: str = "dot") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, by vector best-fit on falling length.

    A piece takes (tokens, one document, length squared as attention cost). Among the open
    sequences that have room in every dimension it goes, under ``dot``, to the one whose
    residual has the smallest weighted dot-product with the demand (the tightest in the
    dimensions that the piece needs); under ``norm``, to the one whose residual after it
    has the smallest weighted norm. Weights are the pieces' mean demand over capacity.
    Sequences with the same residual are interchangeable, so that they are kept by
    residual, and a choice looks at each residual once. A new one opens if none has room.
    """
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    cap = np.asarray(capacity, np.float64)
    demand = np.stack([lengths, np.ones(n), lengths.astype(np.float64) ** 2], axis=1).astype(np.float64)
    weight = demand.mean(axis=0) / cap if n else np.ones(3)
    scale = weight / cap
    residual, members, slot = np.zeros((64, 3)), [[] for _ in range(64)], {}
    free: list[int] = list(range(63, -1, -1))
    opened = 0

    def put(rest: tuple, number: int) -> None:
        nonlocal residual
        at = slot.get(rest)
        if at is None:
            if not free:
                size = len(residual)
                residual = np.concatenate([residual, np.zeros((size, 3))])
                members.extend([] for _ in range(size))
                free.extend(range(2 * size - 1, size - 1, -1))
            at = slot[rest] = free.pop()
            residual[at] = rest
        members[at].append(number)

    for i in np.argsort(-lengths, kind="stable").tolist():
        d = demand[i]
        fits = np.flatnonzero((residual >= d).all(axis=1))
        if len(fits):
            if rule == "dot":
                value = residual[fits] @ (d * scale)
            else:
                value = (((residual[fits] - d) / cap) ** 2) @ weight
            at = int(fits[value.argmin()])
            rest = tuple(residual[at])
            number = members[at].pop()
            if not members[at]:
                residual[at] = 0
                del slot[rest]
                free.append(at)
        else:
            rest, number = tuple(cap), opened
            opened += 1
        sequence[i], offset[i] = number, int(cap[0] - rest[0])
        left = (rest[0] - d[0], rest[1] - d[1], rest[2] - d[2])
        if left[0] > 0:
            put(left, number)
    return sequence, offset


def pack(rows: DataFrame, sequence: int = SEQUENCE, max_docs: int | None = None, max_attention: float | None = None,
         rule: str = "dot", run_pieces: int = RUN_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces. Full pieces stand alone; the others are dealt by a hash of
    their row number into runs of about ``run_pieces``, and each run is packed for itself."""
    capacity = np.array([sequence, max_docs or sequence, max_attention or float(sequence) ** 2], np.float64)
    rows = stage(rows, "pieces")  # counted, then read again; its row numbers stay the same
    runs = max(1, round(rows.filter(F.col("length") < sequence).count() / run_pieces))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable")
        number, offset = best_fit(pdf["length"].to_numpy(), capacity, rule)
        return pdf.assign(sequence_id=(int(key[0]) << 32) + number, offset=offset).drop(columns="run")

    full = F.col("length") == sequence
    alone = rows.filter(full).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    dealt = rows.filter(~full).withColumn("run", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(runs)))
    packed = dealt.groupBy("run").applyInPandas(run, f"{PIECES}, sequence_id long, offset long")
    return packed.unionByName(alone)


def pack_in_order(rows: DataFrame, sequence: int = SEQUENCE, max_docs: int | None = None, max_attention: float | None = None,
                  rule: str = "dot", run_pieces: int = ORDERED_RUN) -> DataFrame:
    """Adds sequence_id and offset to pieces with a place. The shorter pieces of ``run_pieces`` documents in
    a row are a run, packed for itself. A sequence takes the number of the piece that opens it, by place."""
    capacity = np.array([sequence, max_docs or sequence, max_attention or float(sequence) ** 2], np.float64)
    rows = stage(rows, "pieces")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", kind="stable")
        number, offset = best_fit(pdf["length"].to_numpy(), capacity, rule)
        opener = np.zeros(int(number.max()) + 1, np.int64)
        opener[number[offset == 0]] = pdf["place"].to_numpy()[offset == 0]  # all are piece 0
        return pdf.assign(sequence_id=opener[number] << PIECE_BITS, offset=offset).drop(columns=["run", "place"])

    full = F.col("length") == sequence
    alone = rows.filter(full).withColumn("sequence_id", F.shiftleft("place", PIECE_BITS) + F.col("piece")).withColumn(
        "offset", F.lit(0).cast("long")).drop("place")
    dealt = rows.filter(~full).withColumn("run", F.floor(F.col("place") / run_pieces))
    return dealt.groupBy("run").applyInPandas(run, f"{PIECES}, sequence_id long, offset long").unionByName(alone)


def pack_documents(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, in_order: bool = False, **options) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and the end id. Only documents longer than a sequence are cut,
    into full pieces with the shorter one first. Every piece is placed whole; in a
    sequence the pieces lie without gaps from offset 0. Optional capacities: ``max_docs``
    pieces and ``max_attention`` summed squares of lengths in a sequence; by default they
    are what ``sequence`` tokens can reach, and then never bind.

    With ``in_order`` the sequences, by sequence_id, follow the rows of the stored table
    ``docs`` (files by name, rows as they lie in them): a document comes into a sequence
    opened by one of the same ``ORDERED_RUN`` rows. Else pieces are dealt at random.

    Null and empty texts are the end id alone. Rows that repeat are packed as often as they
    occur, null ids too. Ids are computed on whole texts. Empty table: no rows. Other
    columns of ``docs`` are not read.
    """
    packing = pack_in_order if in_order else pack
    return packing(pieces(docs, vocabulary, sequence, in_order=in_order), sequence, **options)


def packed_ids(docs: DataFrame, packed: DataFrame, vocabulary: str, sequence: int = SEQUENCE,
               end_id: int = END_ID) -> DataFrame:
    """The sequences themselves: sequence_id, ids (in order of offset). ``doc_id`` must be unique in ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocabulary)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids, counts = encoder.encode(Texts(part.column("text")))
                at, out = 0, []
                for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                    own = np.append(ids[at : at + n], np.uint32(end_id))
                    at += n
                    start = 0
                    for k, size in enumerate(cut_lengths(n + 1, sequence)):
                        out.append({"doc_id": doc_id, "piece": k, "ids": own[start : start + size].tolist()})
                        start += size
                schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("ids", pa.list_(pa.int32()))])
                yield pa.RecordBatch.from_pylist(out, schema)

    texts = whole_texts(docs).mapInArrow(run, "doc_id long, piece int, ids array<int>")
    return (
        packed.select("doc_id", "piece", "sequence_id", "offset").join(texts, ["doc_id", "piece"])
        .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"))
    )

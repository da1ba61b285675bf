"""Removal of byte strings that an earlier document holds, by interval expansion on a BWT (operator 7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .dealing import SCHEMA, pack, unpack
from .textkit import SpanHash, Texts, mix, slices, unzipped, whole_texts, zipped

#: a string of so many bytes that also starts in an earlier document is removed
LENGTH = 50
#: bytes of the grams among which each string picks its anchor: so many that texts seldom share one by
#: chance, as all contexts of a shared anchor are compared, and their share would grow with the corpus
GRAM = 32
#: anchors that one task compares, bytes of contexts that one task gets, and those in one suffix array, about
TASK_ANCHORS = 1_600_000
TASK_BYTES = 1 << 22
ARRAY_BYTES = 1 << 17
#: an anchor with more different contexts is split by what stands around it
MANY_CONTEXTS = 2000
#: an anchor with more different contexts in one map task is known to be shared by different ones
MANY_LOCAL = 256
#: starts of strings that such a part covers
PART = 4
#: bytes of texts, and of compressed ones, worked on at once: few enough for a core's cache to hold their hashes
TEXT_BYTES = 1 << 17
ZIPPED_BYTES = 1 << 15

_SPAN = LENGTH - GRAM + 1  # grams in a string


def _slide(f: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """f over every window of ``width`` values."""
    n = 1
    while 2 * n <= width and len(x) > n:
        x, n = f(x[:-n], x[n:]), 2 * n
    if width > n and len(x) > width - n:
        x = f(x[: len(x) - (width - n)], x[width - n :])
    return x


def anchors(texts: Texts, spans: SpanHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and text number of every string of LENGTH bytes within a text, and its anchor.

    The anchor is the least hash of the string's grams: equal strings have equal anchors,
    and neighbouring strings mostly share theirs.
    """
    n = len(texts.data) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _slide(np.minimum, spans.windows(GRAM), _SPAN)[:n]
    strings = np.maximum(texts.ends - texts.starts - LENGTH + 1, 0)
    at = np.arange(int(strings.sum())) + np.repeat(texts.starts - (np.cumsum(strings) - strings), strings)
    return at, np.repeat(np.arange(texts.count), strings), least[at]


def contents(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, ch (number of the content), sha (of the whole text) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=TEXT_BYTES):
                texts = Texts(part.column("text"))
                raw = memoryview(texts.data.tobytes())
                sha = [hashlib.sha256(raw[s:e]).digest() for s, e in zip(texts.starts.tolist(), texts.ends.tolist())]
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_bytes": texts.ends - texts.starts,
                    "ch": SpanHash(texts.data).of(texts.starts, texts.ends).view(np.int64), "sha": pa.array(sha, pa.binary())})

    return whole_texts(docs).mapInArrow(run, "doc_id long, n_bytes long, ch long, sha binary")


def stretches(texts: Texts, spans: SpanHash) -> tuple[np.ndarray, ...]:
    """Contexts: strings in a row with one anchor. Start, end (in bytes), text number, anchor and hash of each.

    In a periodic text a context ends after as many strings as hold one anchor.
    """
    at, doc, key = anchors(texts, spans)
    if not len(at):
        return at, at, doc, key, key
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)  # strings of two texts never start in a row
    s = np.flatnonzero(new)
    cuts = (np.diff(np.append(s, len(at))) - 1) // _SPAN + 1
    s = np.repeat(s, cuts) + _SPAN * (np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    e = np.append(s[1:], len(at)) - 1
    return at[s], at[e] + LENGTH, doc[s], key[s], spans.of(at[s], at[e] + LENGTH)


_CONTEXT = np.uint64((1 << 48) - 1)  # six bytes tell the contexts of an anchor apart


def _records(anchor: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Ten bytes for each pair: four of the anchor, six of the context's hash."""
    out = np.empty((len(anchor), 10), np.uint8)
    out[:, :4] = (anchor >> np.uint64(32)).astype("<u4").view(np.uint8).reshape(-1, 4)
    out[:, 4:] = context.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return out


def _fields(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = np.zeros((len(records), 8), np.uint8)
    wide[:, :6] = records[:, 4:]
    return np.ascontiguousarray(records[:, :4]).view("<u4").ravel(), wide.view("<u8").ravel().astype(np.uint64)


def _order(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The order by (key, doc, place), fastest where few keys are equal."""
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    tied = np.zeros(len(key), bool)
    tied[1:] = same
    tied[:-1] |= same
    at = np.flatnonzero(tied)
    own = np.sort(order[at])
    order[at] = own[np.lexsort((doc[own], key[own]))]
    return order


def _sorted_out(anchor: np.ndarray, context: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pairs in order of (anchor, context, document), each once, and three marks of each.

    known: a smaller document has the same context, so that all its strings go; first: the
    smallest document with the context; number: of the anchor.
    """
    # the upper bits of both decide; where they do not, a pair more has to be compared
    upper = anchor if anchor.dtype == np.uint32 else anchor >> np.uint64(32)
    order = _order((upper.astype(np.uint64) << np.uint64(32)) | (context & np.uint64(0xFFFFFFFF)), doc)
    anchor, context, doc = anchor[order], context[order], doc[order]
    same_anchor = anchor[1:] == anchor[:-1]
    same = same_anchor & (context[1:] == context[:-1])
    once = np.ones(len(anchor), bool)
    once[1:] = ~(same & (doc[1:] == doc[:-1]))
    anchor, context, doc = anchor[once], context[once], doc[once]
    first = np.ones(len(anchor), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
    number = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]])[: len(anchor)]).astype(np.int64)
    return anchor, context, doc, first, number


def _dealt_contexts(docs: DataFrame, tasks: int) -> DataFrame:
    """(anchor, context) pairs of the documents, packed by the task that compares them.

    A map task sorts out its own pairs first. A document after the first one with a context
    is known to lose it: that passes through a task chosen at random (from ``tasks`` on). So
    do the contexts of an anchor that has very many different ones here, all but two
    (from ``2 * tasks`` on: they have to be compared by their bytes). What comes to the task
    of an anchor thus does not grow with the number of documents that share a context.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def packed() -> Iterator[pa.RecordBatch]:
            anchor, context, doc, first, number = _sorted_out(*(np.concatenate(x) for x in zip(*held)))
            spread = (mix(doc.view(np.uint64)) % np.uint64(tasks)).astype(np.int32)
            to = (anchor % np.uint64(tasks)).astype(np.int32)
            to[~first] = tasks + spread[~first]
            kinds = np.bincount(number[first], minlength=int(number[-1]) + 1)
            at = np.flatnonzero(first & (kinds[number] > MANY_LOCAL))
            if len(at):  # of each such anchor two contexts go on to its task, of different documents if it has them
                lead = np.concatenate([[True], number[at][1:] != number[at][:-1]])
                head = doc[at[lead]][np.cumsum(lead) - 1]
                other = np.flatnonzero(doc[at] != head)
                several, pick = np.unique(number[at[other]], return_index=True)
                stay = lead.copy()
                stay[other[pick]] = True
                alone = np.flatnonzero(lead & ~np.isin(number[at], several))
                stay[alone + 1] = True  # else a document elsewhere with the same context would not be compared
                to[at[~stay]] = 2 * tasks + spread[at[~stay]]
            least = int(doc.min())
            if int(doc.max()) - least < 1 << 32:  # one key instead of two
                order = np.argsort((to.astype(np.int64) << 32) | (doc - least))
            else:
                order = np.lexsort((doc, to))
            yield from pack(_records(anchor, context)[order], doc[order], to[order])

        for batch in batches:
            for part in slices(batch, limit=TEXT_BYTES):
                texts = Texts(part.column("text"))
                spans = SpanHash(texts.data)
                ids = part.column("doc_id").to_numpy()
                fresh = np.zeros(texts.count, bool)
                for i, (c, d) in enumerate(zip(spans.of(texts.starts, texts.ends).tolist(), ids.tolist())):
                    fresh[i] = d < seen.get(c, d + 1)
                    if fresh[i]:
                        seen[c] = d
                _, _, doc, key, context = stretches(texts, spans)
                own = fresh[doc]
                held.append((key[own], context[own] & _CONTEXT, ids[doc[own]]))
                count += int(own.sum())
                if count >= 1 << 20:
                    yield from packed()
                    held, count = [], 0
        if count:
            yield from packed()

    return whole_texts(docs).filter(F.col("doc_id").isNotNull()).mapInArrow(run, SCHEMA)


def _judged(tasks: int):
    """By document: contexts that a smaller one has as well, and contexts to be compared by their bytes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        records, doc = unpack(table, 10)
        anchor, context = _fields(records)
        role = key[0].as_py() // tasks
        if role == 0:
            anchor, context, doc, first, number = _sorted_out(anchor, context, doc)
            # an anchor of one document only, or of one context only, has nothing to compare
            begin = np.searchsorted(number, np.arange(int(number[-1]) + 1))
            least, most = np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)
            kinds = np.bincount(number[first], minlength=len(least))
            compare = first & (kinds > 1)[number] & (least < most)[number]
            gone = ~first
        else:
            gone = np.full(len(doc), role == 1)
            compare = ~gone
        live = gone | compare
        context, doc, gone = context[live], doc[live], gone[live]
        order = np.lexsort((gone, doc))
        context, doc, gone = context[order], doc[order], gone[order]
        if not len(doc):
            return pa.table({"doc_id": doc, "compare": pa.array([], pa.binary()), "gone": pa.array([], pa.binary())})
        new = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        end = np.append(new[1:], len(doc))
        middle = end - np.add.reduceat(gone.astype(np.int64), new)
        return pa.table({
            "doc_id": doc[new],
            "compare": pa.array([context[s:m].tobytes() for s, m in zip(new, middle)], pa.binary()),
            "gone": pa.array([context[m:e].tobytes() for m, e in zip(middle, end)], pa.binary())})

    return run


def _listed(doc: np.ndarray, context: np.ndarray, lists: list[list[bytes]]) -> np.ndarray:
    """Whether each context (six bytes, as all in the lists are) is in the lists of its document, by number below 2**16."""
    raw = [b"".join(x) for x in lists]
    owner = np.repeat(np.arange(len(raw), dtype=np.uint64), [len(r) // 8 for r in raw])
    keys = np.sort(np.frombuffer(b"".join(raw), np.uint64) | (owner << np.uint64(48)))
    if not len(keys):
        return np.zeros(len(doc), bool)
    own = context | (doc.astype(np.uint64) << np.uint64(48))
    return keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] == own


def _found(rows: DataFrame) -> DataFrame:
    """From (doc_id, z, gone, compare): cuts (ch, doc_id, s, e) that are known, without context; and the
    contexts to be compared with their anchor, s and e being their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "z", ZIPPED_BYTES):
                texts = Texts(unzipped(part.column("z")))
                spans = SpanHash(texts.data)
                ch = spans.of(texts.starts, texts.ends).view(np.int64)
                ids = part.column("doc_id").to_numpy()
                s, e, doc, key, context = stretches(texts, spans)
                context &= _CONTEXT
                gone = _listed(doc, context, part.column("gone").to_pylist())
                place = s - texts.starts[doc], e - texts.starts[doc]
                cut = np.flatnonzero(gone)
                if len(cut):  # cuts that touch are one
                    new = np.ones(len(cut), bool)
                    new[1:] = (doc[cut][1:] != doc[cut][:-1]) | (place[0][cut][1:] > place[1][cut][:-1])
                    lead = np.flatnonzero(new)
                    ends = np.maximum.reduceat(place[1][cut], lead)
                    d = doc[cut[lead]]
                    none = pa.nulls(len(lead), pa.int64()), pa.nulls(len(lead), pa.binary())
                    yield _rows(ch[d], ids[d], place[0][cut[lead]], ends, *none)
                cmp = np.flatnonzero(~gone & _listed(doc, context, part.column("compare").to_pylist()))
                if len(cmp):
                    raw = texts.data.tobytes()
                    text = pa.array([raw[a:b] for a, b in zip(s[cmp].tolist(), e[cmp].tolist())], pa.binary())
                    yield _rows(ch[doc[cmp]], ids[doc[cmp]], place[0][cmp], place[1][cmp], key[cmp].view(np.int64), text)

    return rows.mapInArrow(run, _FOUND)


_FOUND = "ch long, doc_id long, s long, e long, anchor long, context binary"


def _rows(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["ch", "doc_id", "s", "e", "anchor", "context"])


def _split_around(rows: DataFrame) -> DataFrame:
    """Contexts of anchors with many of them, in parts of PART strings each.

    All strings of a part hold the bytes in its middle; their hash replaces the anchor, so
    that equal strings still meet and different surroundings go apart. The parts are laid
    by the anchor's place, which equal strings share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["ch", "doc_id", "s", "e", "anchor", "context"]
        for batch in batches:
            out: list[tuple] = []
            for ch, doc_id, at, _, anchor, context in zip(*(batch.column(c).to_pylist() for c in names)):
                spans = SpanHash(np.frombuffer(context, np.uint8))
                grams = spans.windows(GRAM)
                strings = len(context) - LENGTH + 1
                place = sliding_window_view(grams, _SPAN)[:strings].argmin(axis=1)  # of the anchor in each
                cell = place // PART
                cuts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (place[1:] != place[:-1] - 1), [True]]))
                for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    c = int(cell[s])
                    q = s + int(place[s])  # the anchor; the part's strings start from q - c PART - PART + 1 to q - c PART
                    core = spans.of(np.array([q - c * PART]), np.array([q - c * PART - PART + 1 + LENGTH]))
                    key = mix(core + np.uint64(c) + np.array([anchor], np.int64).view(np.uint64))
                    out.append((ch, doc_id, at + s, at + e - 1 + LENGTH, int(key.view(np.int64)[0]), context[s : e - 1 + LENGTH]))
            kinds = (pa.int64(),) * 5 + (pa.binary(),)
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return rows.select("ch", "doc_id", "s", "e", "anchor", "context").mapInArrow(run, _FOUND)


def _strings(rows: DataFrame) -> DataFrame:
    """Each string of LENGTH bytes of the contexts in a row of its own: ch, doc_id, s, e, string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context = batch.column("context").to_pylist()
            count = np.fromiter((len(c) - LENGTH + 1 for c in context), np.int64, len(context))
            place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            s = np.repeat(batch.column("s").to_numpy(), count) + place
            yield pa.record_batch({
                "ch": np.repeat(batch.column("ch").to_numpy(), count), "doc_id": np.repeat(batch.column("doc_id").to_numpy(), count),
                "s": s, "e": s + LENGTH,
                "string": pa.array([c[k : k + LENGTH] for c in context for k in range(len(c) - LENGTH + 1)], pa.binary())})

    return rows.select("ch", "doc_id", "s", "context").mapInArrow(run, "ch long, doc_id long, s long, e long, string binary")


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes of an array of numbers up to 256, in which each 0 is an end of its own.

    Seven symbols are the first key; then places that are equal so far are ordered by the
    ranks of what follows, twice as far each time. Places equal up to their end stay in
    order of place.
    """
    n = len(codes)
    stops = np.flatnonzero(codes == 0)  # the last symbol is one
    left = np.repeat(stops, np.diff(stops, prepend=-1)) - np.arange(n)  # symbols before the end
    wide = np.zeros(n + 7, np.uint64)
    wide[:n] = codes
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key <<= np.uint64(9)
        key |= np.where(left >= k, wide[k : k + n], np.uint64(0))
    order = np.argsort(key)  # ties are settled below, ended ones by place
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.empty(n, np.int64)  # of a place: where its group starts
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    width = 7
    while True:
        tied = np.zeros(n, bool)
        tied[:-1] = ~new[1:]
        tied |= ~new
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        own = order[at]
        ended = left[own] < width
        after = np.where(ended, own, rank[np.minimum(own + width, n - 1)])
        key = rank[own] * n + after
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[at] = own
        split = np.ones(len(at), bool)
        split[1:] = key[1:] != key[:-1]
        new[at] = split
        rank[own] = at[np.flatnonzero(split)[np.cumsum(split) - 1]]
        width *= 2


def common_prefix_groups(bwt: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix, in order, differs from the one before within ``length`` symbols.

    bwt: symbol before each suffix, first: its first symbol. Prepending a symbol c maps the
    suffixes preceded by c, in their order, onto the suffixes beginning with c. So an
    interval of suffixes with a common prefix of l symbols expands backwards into intervals
    for l + 1, and two neighbours in such an interval come apart exactly if the places they
    come from lie in different intervals for l. All intervals of one length are expanded
    together, by increasing length, and only places not yet apart are looked at; it stops
    at ``length``.
    """
    n = len(bwt)
    source = np.argsort(bwt, kind="stable")
    apart = np.ones(n, bool)
    apart[1:] = first[1:] != first[:-1]
    apart[first == 0] = True  # ends of contexts never match
    open_ = np.flatnonzero(~apart)
    here, above = source[open_].astype(np.int32), source[open_ - 1].astype(np.int32)
    step = apart.astype(np.int32)
    interval = np.empty(n, np.int32)
    for k in range(length - 1):
        if not len(open_):
            break
        np.cumsum(step, out=interval)
        parted = interval[here] != interval[above]
        step[open_[parted]] = 1
        if k < 8 or k % 6 == 0:  # a place that stays in the list though it is apart is found apart again
            live = ~parted
            open_, here, above = open_[live], here[live], above[live]
    return step > 0


def _least_by_place(contexts: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each context starts in a row of all, 0s between them, and for each place there the least id of a
    context that holds the string of LENGTH bytes from it; of use where the place's own context holds it whole."""
    codes = np.zeros(int((sizes + 1).sum()) + 1, np.uint16)  # a 0 in front and after each context
    starts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    inside = np.ones(len(codes), bool)
    inside[0] = False
    inside[starts + sizes] = False
    codes[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.uint16) + 1
    order = suffix_array(codes)
    apart = common_prefix_groups(codes[order - 1], codes[order], LENGTH)
    last = np.repeat(np.concatenate([[0], starts + sizes]), np.concatenate([[1], sizes + 1]))[order]
    id_of = np.repeat(np.concatenate([[0], ids]), np.concatenate([[1], sizes + 1]))[order]
    own = np.where(order + LENGTH <= last, id_of, np.iinfo(np.int64).max)
    at = np.flatnonzero(apart)
    least = np.empty(len(codes), np.int64)
    least[order] = np.minimum.reduceat(own, at)[np.cumsum(apart) - 1]
    return starts, least


def least_ids(contexts: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """For each string of LENGTH bytes in each context, the least id of a context that holds it."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    starts, least = _least_by_place(contexts, sizes, ids)
    return [least[s : s + n - LENGTH + 1] for s, n in zip(starts.tolist(), sizes.tolist())]


def repeats(contexts: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings in a row that a context with a smaller id holds too: number of the context, start and end (in bytes) in it."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    starts, least = _least_by_place(contexts, sizes, ids)
    strings = np.maximum(sizes - LENGTH + 1, 0)
    at = np.arange(int(strings.sum())) + np.repeat(starts - (np.cumsum(strings) - strings), strings)
    hit = np.zeros(len(least), bool)
    hit[at] = least[at] < np.repeat(ids, strings)
    edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))  # no string starts just before a context
    s = np.flatnonzero(edge == 1)
    number = np.searchsorted(starts, s, side="right") - 1
    return number, s - starts[number], np.flatnonzero(edge == -1) - 1 + LENGTH - starts[number]


def _may_share(contexts: list[bytes], anchor: np.ndarray) -> np.ndarray:
    """Whether each context can share a string with another one of its anchor.

    Equal strings agree in the anchor and in LENGTH - GRAM bytes around it, hence in half of
    these on its left or on its right. A context that is alone with both halves is left
    out; one that holds its anchor more than once, or is too short for a half, is not judged
    by that half's hash but kept if the other does not settle it.
    """
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    starts = np.cumsum(sizes) - sizes
    spans = SpanHash(np.frombuffer(b"".join(contexts), np.uint8))
    grams = spans.windows(GRAM)
    inside = np.repeat(np.arange(len(sizes)), sizes - GRAM + 1)
    at = np.arange(len(inside)) + np.repeat(starts - (np.cumsum(sizes - GRAM + 1) - (sizes - GRAM + 1)), sizes - GRAM + 1)
    own = grams[at]
    least = np.minimum.reduceat(own, np.cumsum(sizes - GRAM + 1) - (sizes - GRAM + 1))
    hits = np.flatnonzero(own == least[inside])
    times = np.bincount(inside[hits], minlength=len(sizes))
    q = np.zeros(len(sizes), np.int64)
    q[inside[hits]] = at[hits]
    live = times > 1
    half = (LENGTH - GRAM + 1) // 2
    for s, e in ((q - half, q), (q + GRAM, q + GRAM + half)):
        able = np.flatnonzero((s >= starts) & (e <= starts + sizes) & (times == 1))
        key = mix(spans.of(s[able], e[able]) + anchor[able].view(np.uint64))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        live[able] |= count[back] > 1
    several = np.flatnonzero(times > 1)
    if len(several):  # what repeats its anchor may meet any of its contexts
        live |= np.isin(anchor, anchor[several])
    return live


def _whole_anchors(anchor: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Cuts contexts in order of anchor into parts of whole anchors, up to the bound of a suffix array or one anchor over it."""
    stops = np.flatnonzero(np.append(anchor[1:] != anchor[:-1], True)[: len(anchor)]) + 1
    total = np.cumsum(sizes)
    at = 0
    while at < len(anchor):
        done = total[at - 1] if at else 0
        bound = int(np.searchsorted(total, done + ARRAY_BYTES)) + 1  # with this many contexts it is reached
        end = int(stops[min(np.searchsorted(stops, bound), len(stops) - 1)])
        yield slice(at, end)
        at = end


def _repeated(table: pa.Table) -> pa.Table:
    """Cuts (ch, doc_id, s, e): strings of the contexts of one task that a smaller document's context has too."""
    anchor, ids = table.column("anchor").to_numpy(), table.column("doc_id").to_numpy()
    ch, place = table.column("ch").to_numpy(), table.column("s").to_numpy()
    sizes = table.column("e").to_numpy() - place
    context = table.column("context").to_pylist()
    rows: list[tuple[np.ndarray, ...]] = []
    order = np.argsort(anchor, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]])) if len(order) else np.zeros(0, np.int64)
    several = np.diff(np.append(new, len(order))) > 1
    order = order[np.repeat(several, np.diff(np.append(new, len(order))))]
    parts = [order[part] for part in _whole_anchors(anchor[order], sizes[order])]
    parts = [part[_may_share([context[i] for i in part.tolist()], anchor[part])] for part in parts]
    order = np.concatenate([order[:0], *parts])
    for part in _whole_anchors(anchor[order], sizes[order]):  # each goes into one suffix array
        own = order[part]
        number, s, e = repeats([context[i] for i in own.tolist()], ids[own])
        number = own[number]
        rows.append((ch[number], ids[number], place[number] + s, place[number] + e))
    columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 4
    return pa.table(dict(zip(("ch", "doc_id", "s", "e"), columns)))


def _removed(rows: DataFrame) -> DataFrame:
    """ch, removed (number of bytes), spans, rest (its digest) from (ch, z, cuts) with cuts of (from, to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "z", ZIPPED_BYTES):
                texts = Texts(unzipped(part.column("z")))
                ch = part.column("ch").to_numpy()
                mine = SpanHash(texts.data).of(texts.starts, texts.ends).view(np.int64) == ch
                out = []
                for i, cuts in enumerate(part.column("cuts").to_pylist()):
                    if not mine[i]:
                        continue
                    own = texts.data[texts.starts[i] : texts.ends[i]]
                    edge = np.zeros(len(own) + 1, np.int64)
                    pairs = np.array([(c["s"], c["e"]) for c in cuts], np.int64)
                    np.add.at(edge, pairs[:, 0], 1)
                    np.add.at(edge, pairs[:, 1], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    out.append((int(ch[i]), int(gone.sum()), spans, hashlib.sha256(own[~gone].tobytes()).digest()))
                columns = list(zip(*out)) if out else [()] * 4
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                                 ["ch", "removed", "spans", "rest"])

    return rows.mapInArrow(run, "ch long, removed long, spans long, rest binary")


def repeated_cuts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Contents (doc_id, n_bytes, ch, sha of every row), and cuts (ch, s, e) of each content's first document."""
    docs = whole_texts(docs, id_col, text_col)
    rows = stage(contents(docs), "contents")
    known = rows.filter("doc_id is not null")
    firsts = known.groupBy("ch").agg(F.min("doc_id").alias("first_id"))
    total = known.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(32, int(2 * total / (_SPAN + 1) / TASK_ANCHORS))
    # written, so that the packed pairs and the texts do not lie in shuffles at the same time
    judged = stage(_dealt_contexts(docs, tasks).groupBy("task").applyInArrow(
        _judged(tasks), "doc_id long, compare binary, gone binary"), "judged", "zstd")
    of_doc = judged.groupBy("doc_id").agg(F.collect_list("compare").alias("compare"), F.collect_list("gone").alias("gone"))
    of_doc = of_doc.join(firsts.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    found = stage(_found(zipped(docs).join(of_doc, "doc_id").select("doc_id", "z", "gone", "compare")), "contexts", "zstd")
    open_ = found.filter("context is not null")
    # written, so that Spark knows its size: while it is small, the contexts are not shuffled for it
    many = stage(open_.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > MANY_CONTEXTS).select("anchor"), "many")
    # parts of different contexts may be alike: of these too only the first document's is compared
    apart = stage(_split_around(open_.join(many, "anchor", "left_semi")), "parts", "zstd")
    first = apart.groupBy("anchor", "context").agg(F.min("doc_id").alias("first_doc"))
    apart = stage(apart.join(first, ["anchor", "context"]), "firsts", "zstd")  # read three times
    later = apart.filter("doc_id > first_doc").select("ch", "doc_id", "s", "e")
    apart = apart.filter("doc_id = first_doc").select(*open_.columns)
    # parts whose middle is common too: their few strings are told apart one by one, without a task for all of them
    crowded = stage(apart.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > MANY_CONTEXTS).select("anchor"), "crowded")
    alone = _strings(apart.join(crowded, "anchor", "left_semi"))
    least = alone.groupBy("string").agg(F.min("doc_id").alias("first_doc"))
    alone = alone.join(least, "string").filter("doc_id > first_doc").select("ch", "doc_id", "s", "e")
    size = open_.agg(F.sum(F.octet_length("context"))).first()[0] or 0
    parts = max(32, int(size / TASK_BYTES))
    compared = (
        open_.join(many, "anchor", "left_anti").select(*open_.columns).unionByName(
            apart.join(crowded, "anchor", "left_anti").select(*open_.columns))
        .withColumn("task", F.pmod(F.xxhash64("anchor"), F.lit(parts)))
        .groupBy("task").applyInArrow(_repeated, "ch long, doc_id long, s long, e long")
    )
    cuts = found.filter("context is null").select("ch", "doc_id", "s", "e").unionByName(compared).unionByName(later).unionByName(alone)
    return rows, cuts.join(firsts.select("ch", F.col("first_id").alias("doc_id")), ["ch", "doc_id"]).select("ch", "s", "e")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte goes that is covered by a string of 50 bytes of the text which also starts
    in a document with a smaller id; matches never cross documents, and all are judged on
    the input.

    1. Equal texts are one content; all but its first document go whole (if 50 bytes or more).
    2. Each string has an anchor, the least hash of its grams; strings in a row with one
       anchor form a context. Hashes of (anchor, context) come to the anchor's task, packed.
       After the first document with a context all others lose it. Different contexts of
       a shared anchor have to be compared.
    3. Their bytes, one copy of each, come to one task by anchor. A Burrows-Wheeler transform
       of them is expanded backwards, breadth first, until intervals have a common prefix
       of 50 bytes; an interval's least id is that of the first document with the string.
       Contexts that agree with no other one on either side of their anchor are left out
       before. Anchors with very many contexts are split by what stands around them, and
       where that is common too, string by string.
    4. The cuts go back to the documents, and the first one of each content is cut once.

    Null and empty texts have nothing to remove. A row with a null id is compared with
    nothing and stays whole. Rows that repeat an id and text are cut alike. Empty table:
    no rows. Contents and anchors are told apart by 64-bit hashes, strings by their bytes.
    """
    rows, cuts = repeated_cuts(docs, id_col, text_col)
    docs = whole_texts(docs, id_col, text_col)
    firsts = rows.filter("doc_id is not null").groupBy("ch").agg(F.min("doc_id").alias("first_id"))
    marked = cuts.groupBy("ch").agg(F.collect_list(F.struct("s", "e")).alias("cuts")).join(firsts, "ch")
    texts = zipped(docs)
    done = _removed(texts.join(marked, texts["doc_id"] == marked["first_id"]).select("ch", "z", "cuts")).dropDuplicates(["ch"])
    later = (F.col("doc_id") > F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    first = F.col("doc_id") == F.col("first_id")
    return rows.join(firsts, "ch", "left").join(done, "ch", "left").select(
        "doc_id", "n_bytes",
        F.when(later, F.col("n_bytes")).when(first, F.coalesce("removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(later, 1).when(first, F.coalesce("spans", F.lit(0))).otherwise(0).cast("long").alias("n_spans"),
        F.when(later, F.sha2(F.lit(""), 256)).when(first & F.col("rest").isNotNull(), F.lower(F.hex("rest")))
        .otherwise(F.lower(F.hex("sha"))).alias("kept_sha256"))

"""N-gram Jaccard join with count vectors in R-trees (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .components import components
from .dealing import SCHEMA, pack, unpack
from .textkit import ASCII_LOWER, SpanHash, Texts, mix, slices, unzipped, whole_texts, zipped

#: words of a shingle; two sets link when 100 * intersection >= 80 * union
WORDS = 5
#: token groups of the shortest count vector; larger sets have a power of two more, two tokens to a group at most
GROUPS = 64
#: token signatures that one task compares, about
TASK_SIGNATURES = 400_000
#: a signature of more sets of one map task is known to be shared: its sets need not all meet in one task
MANY_LOCAL = 64
#: points that one task joins, about
TASK_POINTS = 20_000
#: points of an R-tree that one task joins with another such tree
TREE_POINTS = 1024
LEAF = 16

_STEP = mix(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)
_GROUP_SALT = np.uint64(0xA0761D6478BD642F)

#: lower ends of the size classes: a set's partners are in its class or a neighbouring one
CLASS_START = [1]
while CLASS_START[-1] < 1 << 40:
    CLASS_START.append(CLASS_START[-1] * 3 // 2 + 1)
CLASS_START = np.array(CLASS_START, np.int64)


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' distinct shingles, sorted within each text, and how many each text has."""
    texts.data = ASCII_LOWER[texts.data]
    ws, we, wd = texts.words()
    wh = SpanHash(texts.data).of(ws, we)
    n_words = np.bincount(wd, minlength=texts.count)
    counts = np.where(n_words >= WORDS, n_words - WORDS + 1, np.minimum(n_words, 1))
    m = max(0, len(wh) - WORDS + 1)
    key = np.zeros(m, np.uint64)
    for k in range(WORDS):
        key += wh[k : k + m] * _STEP[k]
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.empty(int(counts.sum()), np.uint64)
    short = (n_words > 0) & (n_words < WORDS)
    long_slots = np.ones(len(out), bool)
    long_slots[starts[short]] = False
    out[long_slots] = key[wd[:m] == wd[WORDS - 1 :]] if m else 0
    first_word = np.cumsum(n_words) - n_words
    for i in np.flatnonzero(short).tolist():  # the whole sequence is the only shingle
        own = wh[first_word[i] : first_word[i] + n_words[i]]
        out[starts[i]] = (own * _STEP[: len(own)]).sum() + np.uint64(n_words[i])
    out = mix(out)
    for s, e in zip(starts.tolist(), ends.tolist()):
        out[s:e].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[starts[counts > 0]] = True
    doc = np.repeat(np.arange(texts.count), counts)
    return out[fresh], np.bincount(doc[fresh], minlength=texts.count)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum (modulo 2**64) of consecutive runs of the given sizes, which may be 0."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    end = np.cumsum(sizes)
    return total[end] - total[end - sizes]


def fingerprints(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number per set, the same for equal sets."""
    return mix(_sums(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), sizes) + sizes.astype(np.uint64)).view(np.int64)


def count_vectors(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Number of a set's tokens in each group, a byte each.

    The group is the hash modulo the number of groups, so that a longer vector folds into
    a shorter one by summing.
    """
    out = []
    end = np.cumsum(sizes)
    for s, e in zip((end - sizes).tolist(), end.tolist()):
        groups = GROUPS
        while groups * 2 < e - s:
            groups *= 2
        counts = np.bincount((hashes[s:e] % np.uint64(groups)).astype(np.int64), minlength=groups)
        while counts.max() > 255:  # hardly ever with hashes that spread, but the bound must stay one
            groups *= 2
            counts = np.bincount((hashes[s:e] % np.uint64(groups)).astype(np.int64), minlength=groups)
        out.append(counts.astype(np.uint8).tobytes())
    return out


class Vectors:
    """Count vectors of several lengths, with bounds on the overlap of pairs of them."""

    def __init__(self, column: list[bytes]):
        self.length = np.fromiter(map(len, column), np.int64, len(column))
        self.flat = np.frombuffer(b"".join(column), np.uint8)
        self.start = np.cumsum(self.length) - self.length
        self.short = self.folded(np.arange(len(column)), GROUPS)

    def folded(self, rows: np.ndarray, groups: int) -> np.ndarray:
        out = np.empty((len(rows), groups), np.int32)
        for n in np.unique(self.length[rows]).tolist():
            own = np.flatnonzero(self.length[rows] == n)
            v = self.flat[self.start[rows[own]][:, None] + np.arange(n)[None, :]]
            out[own] = v.reshape(len(own), n // groups, groups).sum(axis=1, dtype=np.int32)
        return out

    def allowed(self, i: np.ndarray, j: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the pairs (i, j) may link: by the shortest vectors first, then by the longest both have."""
        keep = np.zeros(len(i), bool)
        for s in range(0, len(i), 8192):
            x, y = i[s : s + 8192], j[s : s + 8192]
            bound = np.minimum(self.short[x], self.short[y]).sum(axis=1)
            keep[s : s + 8192] = may_link(bound, sizes[x], sizes[y])
        live = np.flatnonzero(keep)
        groups = np.minimum(self.length[i[live]], self.length[j[live]])
        for n in np.unique(groups[groups > GROUPS]).tolist():
            own = live[groups == n]
            step = max(1, (1 << 20) // n)
            for s in range(0, len(own), step):
                at = own[s : s + step]
                bound = np.minimum(self.folded(i[at], n), self.folded(j[at], n)).sum(axis=1)
                keep[at] = may_link(bound, sizes[i[at]], sizes[j[at]])
        return keep


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of each set, with its number: linked sets have one in common.

    Linked sets of sizes a and b differ in d <= (a + b) / 9 tokens. Tokens are split into
    groups by hash; of the groups in order that hold a token of either set, at most d differ,
    so that the first one with equal content is among the first d + 1 of both. A set hence
    shows the content of its first T + 1 groups, T being d's bound against any partner. A
    set with T groups or fewer also shows its smallest fifth of tokens (and one more): of
    those, linked sets always share one. The number of groups follows the size class; a
    set that may have partners in the class above shows itself there too.
    """
    found_sig, found_doc = [], []
    cls = np.searchsorted(CLASS_START, sizes, side="right") - 1
    for up in (0, 1):
        k = cls + up
        top = CLASS_START[np.minimum(k + 1, len(CLASS_START) - 1)] - 1
        partner = sizes * 5 // 4
        take = (sizes > 0) & ((up == 0) | (partner >= CLASS_START[np.minimum(k, len(CLASS_START) - 1)]))
        limit = (sizes + np.minimum(partner, top)) // 9
        groups = top * 26 // 100 + 3
        own = np.flatnonzero(take)
        if not len(own):
            continue
        keep = np.repeat(take, sizes)
        h = hashes[keep]
        n = sizes[own]
        doc = np.repeat(np.arange(len(own)), n)
        g = ((h >> np.uint64(32)) * groups[own][doc].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(h), bool)
        new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        content = np.add.reduceat(mix(h ^ _GROUP_SALT), at)
        gdoc = doc[at]
        n_groups = np.bincount(gdoc, minlength=len(own))
        rank = np.arange(len(at)) - (np.cumsum(n_groups) - n_groups)[gdoc]
        shown = rank <= limit[own][gdoc]
        level = mix(k[own].astype(np.uint64) + np.uint64(77))
        found_sig.append(mix(content[shown] + mix(g[at][shown]) + level[gdoc[shown]]))
        found_doc.append(own[gdoc[shown]])
        thin = n_groups <= limit[own]
        if thin.any():
            place = np.arange(len(h)) - (np.cumsum(n) - n)[doc]
            shown = thin[doc] & (place <= n[doc] - (4 * n[doc] + 4) // 5)
            found_sig.append(mix(h[shown] ^ (level[doc[shown]] * np.uint64(3))))
            found_doc.append(own[doc[shown]])
    if not found_sig:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found_sig), np.concatenate(found_doc)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp (number of the set, null if empty), vec (count vector) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, sizes = shingle_sets(Texts(part.column("text")))
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_shingles": sizes.astype(np.int64),
                    "fp": pa.array(fingerprints(hashes, sizes), mask=sizes == 0),
                    "vec": pa.array(count_vectors(hashes, sizes), pa.binary())})

    return whole_texts(docs).mapInArrow(run, "doc_id long, n_shingles long, fp long, vec binary")


def _dealt_signatures(docs: DataFrame, tasks: int) -> DataFrame:
    """Signatures of each distinct set, packed by the task that will compare them.

    The lowest bit of a signature is a mark. Where very many sets of one map task show a
    signature, two of them go on to its task, marked; the others, which are sure to meet
    them, pass through tasks chosen at random (from ``tasks`` on). What comes together
    for one signature thus does not grow with the number of sets that show it.
    """
    flush = 1 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def packed() -> Iterator[pa.RecordBatch]:
            sig, fp = (np.concatenate(x) for x in zip(*held))
            sig &= ~np.uint64(1)
            to = (mix(sig) % np.uint64(tasks)).astype(np.int32)
            order = np.argsort(sig, kind="stable")
            new = np.flatnonzero(np.concatenate([[True], sig[order][1:] != sig[order][:-1]]))
            size = np.diff(np.append(new, len(order)))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order)) - np.repeat(new, size)
            hot = np.empty(len(order), bool)
            hot[order] = np.repeat(size > MANY_LOCAL, size)
            sig[hot] |= np.uint64(1)
            over = hot & (place > 1)
            to[over] = tasks + (mix(fp[over].view(np.uint64)) % np.uint64(tasks)).astype(np.int32)
            order = np.lexsort((np.arange(len(to)), to))
            yield from pack(sig[order], fp[order], to[order])

        for batch in batches:
            for part in slices(batch):
                hashes, sizes = shingle_sets(Texts(part.column("text")))
                fp = fingerprints(hashes, sizes)
                fresh = sizes > 0
                for i, f in enumerate(fp.tolist()):
                    if f in seen:
                        fresh[i] = False
                    seen.add(f)
                hashes, sizes, fp = hashes[np.repeat(fresh, sizes)], sizes[fresh], fp[fresh]
                sig, doc = signatures(hashes, sizes)
                held.append((sig, fp[doc]))
                count += len(sig)
                if count >= flush:
                    yield from packed()
                    held, count = [], 0
        if count:
            yield from packed()

    texts = whole_texts(docs).filter(F.col("doc_id").isNotNull())
    return texts.mapInArrow(run, SCHEMA)


def _meeting_sets(tasks: int):
    """Sets that show the same signature, as (bucket, fp).

    Buckets with the same sets are one; that of a marked signature is known by the
    signature itself, as other tasks hold sets of it too.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        sig, fp = unpack(table)
        if key[0].as_py() >= tasks:
            return pa.table({"bucket": mix(sig >> np.uint64(1)).view(np.int64), "fp": fp})
        marked = (sig & np.uint64(1)) == 1
        sig = sig >> np.uint64(1)
        order = np.lexsort((fp, sig))
        sig, fp, marked = sig[order], fp[order], marked[order]
        new = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(sig))))
        hot = np.zeros(len(new), bool)
        hot[group[marked]] = True
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (fp[1:] != fp[:-1])
        sig, fp, group = sig[fresh], fp[fresh], group[fresh]
        size = np.bincount(group, minlength=len(new))
        bucket = mix(_sums(mix(fp.view(np.uint64)), size) + size.astype(np.uint64))
        bucket[hot] = mix(sig[np.cumsum(size) - size][hot])
        _, first = np.unique(bucket, return_index=True)
        chosen = np.zeros(len(size), bool)
        chosen[first] = True
        chosen &= (size > 1) | hot
        rows = np.repeat(chosen, size)
        return pa.table({"bucket": np.repeat(bucket, size)[rows].view(np.int64), "fp": fp[rows]})

    return run


class RTree:
    """Points packed into leaves by recursive halving; each node has its largest coordinates and least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, groups: np.ndarray):
        order = self._packed(points, np.arange(len(points)))
        self.points, self.sizes, self.groups, self.rows = points[order], sizes[order], groups[order], order
        self.levels = []
        upper, least = self.points, self.sizes
        low, high = self.groups, self.groups
        fan = LEAF
        while True:
            at = np.arange(0, len(upper), fan)
            upper, least = np.maximum.reduceat(upper, at), np.minimum.reduceat(least, at)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((upper, least, low, high))
            if len(upper) == 1:
                break
            fan = 4

    @staticmethod
    def _packed(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= LEAF:
            return rows
        own = points[rows]
        axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
        order = rows[np.argsort(own[:, axis], kind="stable")]
        half = -(-len(rows) // (2 * LEAF)) * LEAF
        return np.concatenate([RTree._packed(points, order[:half]), RTree._packed(points, order[half:])])


def may_link(overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes a and b with at most so large an intersection can link."""
    return 180 * overlap.astype(np.int64) >= 80 * (a.astype(np.int64) + b)


def tree_pairs(left: RTree, right: RTree) -> tuple[np.ndarray, np.ndarray]:
    """Rows of points whose summed coordinate minima allow a link, of different groups.

    Pairs of nodes are followed down from the roots while the summed minima of their
    largest coordinates reach what their least sizes need.
    """
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    depth = max(len(left.levels), len(right.levels))
    for step in range(depth - 1, -1, -1):
        a, b = min(step, len(left.levels) - 1), min(step, len(right.levels) - 1)
        ua, sa, la, ha = left.levels[a]
        ub, sb, lb, hb = right.levels[b]
        keep = []
        for s in range(0, len(i), 4096):
            x, y = i[s : s + 4096], j[s : s + 4096]
            bound = np.minimum(ua[x], ub[y]).sum(axis=1, dtype=np.int64)
            one = (la[x] == ha[x]) & (lb[y] == hb[y]) & (la[x] == lb[y])
            keep.append(may_link(bound, sa[x], sb[y]) & ~one)
        live = np.concatenate(keep)
        i, j = i[live], j[live]
        if not len(i):
            return i, j
        fa = (LEAF if a == 0 else 4) if a == step else 1
        fb = (LEAF if b == 0 else 4) if b == step else 1
        na = len(left.points) if a == 0 else len(left.levels[a - 1][1]) if a == step else len(sa)
        nb = len(right.points) if b == 0 else len(right.levels[b - 1][1]) if b == step else len(sb)
        x = (i[:, None] * fa + np.arange(fa)[None, :])[:, :, None] + np.zeros((1, 1, fb), np.int64)
        y = (j[:, None] * fb + np.arange(fb)[None, :])[:, None, :] + np.zeros((1, fa, 1), np.int64)
        x, y = x.ravel(), y.ravel()
        inside = (x < na) & (y < nb)
        i, j = x[inside], y[inside]
    keep = []
    for s in range(0, len(i), 4096):
        x, y = i[s : s + 4096], j[s : s + 4096]
        bound = np.minimum(left.points[x], right.points[y]).sum(axis=1, dtype=np.int64)
        keep.append(may_link(bound, left.sizes[x], right.sizes[y]) & (left.groups[x] != right.groups[y]))
    live = np.concatenate(keep)
    return left.rows[i[live]], right.rows[j[live]]


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose count vectors allow a link."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("fp").alias(side), F.col("n_shingles").alias(f"n_{side}"),
                                       F.col("vec").alias(f"vec_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, len(batch), 2048):
                p = batch.slice(s, 2048)
                both = Vectors(p.column("vec_a").to_pylist() + p.column("vec_b").to_pylist())
                sizes = np.concatenate([p.column("n_a").to_numpy(), p.column("n_b").to_numpy()])
                keep = both.allowed(np.arange(len(p)), np.arange(len(p)) + len(p), sizes)
                yield p.select(["a", "b"]).filter(pa.array(keep))

    return pairs.filter("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)").mapInArrow(run, "a long, b long")


def _own_text(rows: DataFrame) -> DataFrame:
    """The rows (fp, z) whose text has the set of that number; one id may stand for several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "z"):
                own = fingerprints(*shingle_sets(Texts(unzipped(part.column("z")))))
                yield part.filter(pa.array(own == part.column("fp").to_numpy()))

    return rows.select("fp", "z").mapInArrow(run, "fp long, z binary")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of set numbers, and whether they link, by their whole sets; texts: (fp, z)."""
    one = texts.select(F.col("fp").alias("b"), F.col("z").alias("z_b"))
    two = texts.select(F.col("fp").alias("a"), F.col("z").alias("z_a"))
    rows = pairs.join(one, "b").join(two, "a").select("a", "b", "z_a", "z_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in slices(batch, "z_b"):
                hashes, sizes = shingle_sets(Texts(unzipped(part.column("z_b"))))
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                end = np.cumsum(sizes)
                linked = np.zeros(len(a), bool)
                for i in range(len(a)):
                    if a[i] != last:
                        last, kept = a[i], shingle_sets(Texts(unzipped(part.column("z_a").slice(i, 1))))[0]
                    own = hashes[end[i] - sizes[i] : end[i]]
                    at = np.searchsorted(kept, own)
                    at[at == len(kept)] = 0
                    both = int((kept[at] == own).sum()) if len(kept) else 0
                    linked[i] = 100 * both >= 80 * (len(kept) + len(own) - both)
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                                       "linked": linked})

    return rows.mapInArrow(run, "a long, b long, linked boolean")


def _pairs_of_heads(table: pa.Table) -> pa.Table:
    """Pairs (a, b) of points of one head, of different components, that may link; rows of many heads at a time.

    Points that fit a leaf are compared as one; more of them, or two parts of a head, by R-trees.
    """
    table = table.sort_by([(c, "ascending") for c in ("head", "p", "q", "own", "fp")])
    head, p, q, own, fp, root, n = (table.column(c).to_numpy() for c in ("head", "p", "q", "own", "fp", "root", "n"))
    vectors = Vectors(table.column("vec").to_pylist())
    rows = len(head)
    new = np.ones(rows, bool)
    new[1:] = (head[1:] != head[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], rows)
    small = (end - start <= LEAF) & (p[start] == q[start])
    found = []
    # every point of a small group with every later one
    seg = np.cumsum(new) - 1
    later = np.where(small[seg], end[seg] - np.arange(rows) - 1, 0)
    for s in range(0, rows, 1 << 16):
        part = later[s : s + (1 << 16)]
        i = np.repeat(np.arange(s, s + len(part)), part)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(part) - part, part)
        found.append(_reduced(i, j, fp, root, n, vectors))
    for a, b in zip(start[~small].tolist(), end[~small].tolist()):
        trees = []
        for part in sorted({int(p[a]), int(q[a])}):
            at = a + np.flatnonzero(own[a:b] == part)
            if len(at):
                trees.append((RTree(vectors.short[at], n[at], root[at]), at))
        if len(trees) == 1 and p[a] != q[a]:
            continue
        (left, x), (right, y) = trees[0], trees[-1]
        i, j = tree_pairs(left, right)
        found.append(_reduced(x[i], y[j], fp, root, n, vectors))
    a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    once = np.ones(len(a), bool)
    once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return pa.table({"a": a[once], "b": b[once]})


def _reduced(i: np.ndarray, j: np.ndarray, fp: np.ndarray, root: np.ndarray, n: np.ndarray,
             vectors: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Set numbers of the pairs of rows that may link, the smaller number first, each once."""
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    live = (root[i] != root[j]) & (5 * small >= 4 * large)
    i, j = i[live], j[live]
    a, b = np.minimum(fp[i], fp[j]), np.maximum(fp[i], fp[j])
    order = np.lexsort((b, a))
    once = np.ones(len(a), bool)
    once[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    at = order[once]
    at = at[vectors.allowed(i[at], j[at], n)]
    return a[at], b[at]


def _across(met: DataFrame, heads: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that met in a bucket, are in different components and may link by R-tree.

    Buckets with one head hold much the same points, so the points of all of them are joined
    at once. A head's points are cut into parts of about TREE_POINTS, joined two by two.
    """
    now = met.join(roots, met["fp"] == roots["node"], "left").select(
        "bucket", "fp", F.coalesce("root", "fp").alias("root"))
    mixed = now.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"))
    # two sets alone have been compared already
    mixed = mixed.filter("lo <> hi and n > 2").select("bucket").join(heads, "bucket")
    points = now.join(mixed, "bucket").select("head", "fp", "root").distinct()
    parts = points.groupBy("head").agg(F.ceil(F.count("*") / TREE_POINTS).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int")
    tasks = max(32, sets.count() // TASK_POINTS)
    each = (
        points.join(parts, "head").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(sets.select("fp", "n_shingles", "vec"), "fp")
        .select("head", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "fp", "root",
                F.col("n_shingles").alias("n"), "vec")
        .withColumn("task", F.pmod(F.xxhash64("head", "p", "q"), F.lit(tasks)))
    )
    return each.groupBy("task").applyInArrow(_pairs_of_heads, "a long, b long").distinct()


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A document's set: the distinct shingles of five words of its whole text (A-Z lower
    case; a shorter text is one shingle). Documents link at a Jaccard similarity of 0.8 or
    more; component_id is the smallest id that a chain of links reaches.

    1. Equal sets are one point (set number, size, count vector of its tokens by group).
    2. Points are dealt into buckets by signatures; linked points always meet in one.
    3. In each bucket every point is held against the bucket's head, the point that is in most
       buckets: summed coordinate minima bound the overlap, what survives is verified on
       the whole sets, and verified links make components.
    4. Buckets whose points are in several components still: R-trees over the points of all
       such buckets with one head find, by the same bound, all pairs across components
       that may link, and these are verified too. So every pair of linked points is
       verified or in one component.

    No task holds a bucket as a whole in step 4 (points are cut into trees of
    ``TREE_POINTS``, joined two by two), and no list of all pairs of a bucket is written.

    Null, empty and blank texts have no shingle and link with nothing, not with each other.
    A row with a null id gets a null component and links nothing. Rows that repeat are
    one point. Empty table: no rows. Sets are compared by 64-bit hashes of their shingles.
    """
    docs = whole_texts(docs, id_col, text_col)
    rows = stage(described(docs), "sets")
    known = rows.filter("doc_id is not null and fp is not null")
    sets = stage(known.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
                                         F.first("vec").alias("vec")), "points")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    tasks = max(32, int(total * 0.4 / TASK_SIGNATURES))
    met = _dealt_signatures(docs, tasks).groupBy("task").applyInArrow(_meeting_sets(tasks), "bucket long, fp long")
    met = stage(met.distinct(), "buckets")
    # the point in most buckets is the least changed copy of a group
    often = met.groupBy("fp").agg(F.count("*").alias("often"))
    heads = stage(met.join(often, "fp").groupBy("bucket").agg(
        F.max_by("fp", F.struct("often", "fp")).alias("head")), "heads")
    star = met.join(heads, "bucket").filter("fp <> head").select(
        F.least("head", "fp").alias("a"), F.greatest("head", "fp").alias("b")).distinct()
    wanted = met.select("fp").distinct().join(sets.select("fp", "doc_id"), "fp")
    texts = stage(_own_text(zipped(docs).join(wanted, "doc_id")).dropDuplicates(["fp"]), "texts")
    checked = stage(_verified(_bounded(star, sets), texts), "pairs")
    roots = stage(components(checked.filter("linked")), "roots")
    across = _across(met, heads, roots, sets).join(checked, ["a", "b"], "left_anti")
    more = stage(_verified(across, texts), "pairs")
    links = checked.unionByName(more).filter("linked").select("a", "b")
    if not more.filter("linked").isEmpty():
        roots = stage(components(links), "roots")
    least = roots.join(sets.select(F.col("fp").alias("node"), "doc_id"), "node").groupBy("root").agg(
        F.min("doc_id").alias("least"))
    of_set = (
        sets.select("fp", "doc_id").join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
        .join(least, "root", "left").select("fp", F.coalesce("least", "doc_id").alias("component_id"))
    )
    return rows.join(of_set, "fp", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("fp").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
        .alias("component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """All documents but those that are linked to one with a smaller id, with all their columns."""
    gone = link_components(docs).filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")

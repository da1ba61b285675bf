"""Embedding whitening (operator 13): weighted covariance of distinct vectors, each whitened once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage

COMPONENTS = 32
#: x of an entry c is floor(SCALE * c) + SHIFT
SCALE, SHIFT = 64.0, 1_000_000
#: entries beyond this have no x among the longs
LARGEST = 1.4e17
#: part of the largest variance below which a component counts as one without variance
FLAT = 1e-13

_EXACT = pa.decimal128(38, 0)


def _matrices(batch: pa.RecordBatch, column: str, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) for each length of vector in a batch."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        yield at, flat[starts[at][:, None] + np.arange(dim)].astype(kind, copy=False)


def _sums(distinct: DataFrame, column: str, kind: type) -> dict[int, tuple[int, list]]:
    """By length of vector: total weight and weighted sum of each dimension (exact for integers).

    A task returns one row per length, dimension and batch, summed again before they reach
    the driver, which gets one row per dimension.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            weight = batch.column("weight").to_numpy(zero_copy_only=False)
            for at, x in _matrices(batch, column, kind):
                w = weight[at]
                if kind is np.int64 and float(np.abs(x).max(initial=0)) * float(w.sum()) > 2.0**62:
                    x, w = x.astype(object), w.astype(object)
                n, s = total.setdefault(x.shape[1], [0, 0])
                add = (w[:, None] * x).sum(axis=0)
                total[x.shape[1]] = [n + int(w.sum()), s + (add.astype(object) if kind is np.int64 else add)]
        for dim, (n, s) in total.items():
            values = [Decimal(int(v)) for v in s] if kind is np.int64 else list(map(float, s))
            yield pa.record_batch({
                "dim": pa.array([dim] * dim, pa.int32()), "i": pa.array(range(dim), pa.int32()), "n": pa.array([n] * dim, pa.int64()),
                "s": pa.array(values, _EXACT if kind is np.int64 else pa.float64())})

    number = "decimal(38,0)" if kind is np.int64 else "double"
    parts = distinct.select("weight", column).mapInArrow(run, f"dim int, i int, n long, s {number}")
    found: dict[int, tuple[int, list]] = {}
    for r in parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim", "i").collect():
        found.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]) if kind is np.int64 else r["s"])
    return found


def _covariances(distinct: DataFrame, column: str, kind: type,
                 sums: dict[int, tuple[int, list]]) -> dict[int, np.ndarray]:
    """By length of vector: covariance over the weights, divisor n, of vectors centred before they are multiplied.

    A task adds up its products and returns one row of the matrix at a time; these are
    summed by row number, so that no task and not the driver holds more than one matrix
    of each length.
    """
    centres = {dim: np.array([s / n if kind is not np.int64 else _ratio(s, n) for s in total]) for dim, (n, total) in sums.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[int, np.ndarray] = {}
        for batch in batches:
            weight = batch.column("weight").to_numpy(zero_copy_only=False).astype(np.float64)
            for at, x in _matrices(batch, column, kind):
                dim = x.shape[1]
                if dim:
                    y = x - centres[dim]
                    grams[dim] = grams.get(dim, 0.0) + (y * weight[at][:, None]).T @ y
        for dim, gram in grams.items():
            yield pa.record_batch({"dim": pa.array([dim] * dim, pa.int32()), "i": pa.array(range(dim), pa.int32()),
                                   "line": pa.array([row.tobytes() for row in gram], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        rows = np.stack([np.frombuffer(b, np.float64) for b in table.column("line").to_pylist()])
        return pa.table({"dim": table.column("dim")[:1], "i": table.column("i")[:1],
                         "line": pa.array([rows.sum(axis=0).tobytes()], pa.binary())})

    form = "dim int, i int, line binary"
    parts = distinct.select("weight", column).mapInArrow(run, form)
    found: dict[int, np.ndarray] = {dim: np.zeros((dim, dim)) for dim in sums}
    for r in parts.groupBy("dim", "i").applyInArrow(add, form).collect():
        found[r["dim"]][r["i"]] = np.frombuffer(r["line"], np.float64)
    return {dim: (c + c.T) / (2 * sums[dim][0]) for dim, c in found.items()}


def _ratio(s: int, n: int) -> float:
    """s / n of integers of any size, rounded once."""
    return s / n


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and x of every row whose vector is whole: not null, no entry null, not finite or beyond the longs."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall("v", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & whole)
        # the addition may be evaluated before the filter
        .select("vec_id", F.transform("v", lambda c: F.try_add(F.floor(c * SCALE).cast("long"), F.lit(SHIFT))).alias("x"))
    )


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[Decimal]:
    """Sum over the dimensions of (n * x - S)^2, exactly."""
    bound = float(np.abs(x).max(initial=0)) * n + max((abs(float(s)) for s in sums), default=0.0)
    if bound < 2.0**62:
        d = x * np.int64(n) - sums.astype(np.int64)
        if float(np.abs(d).max(initial=0)) ** 2 * max(1, x.shape[1]) < 2.0**62:
            return list(map(Decimal, np.einsum("ij,ij->i", d, d).tolist()))
    d = x.astype(object) * n - sums
    return [Decimal(int(v)) for v in (d * d).sum(axis=1)] if x.shape[1] else [Decimal(0)] * len(x)


def whitener(sums: dict[int, tuple[int, list]], covariances: dict[int, np.ndarray], components: int) -> dict[int, dict]:
    """By length of vector: centre, axes (one column each, over the root of the variance), shares of all variance, flat ones."""
    model = {}
    for dim, v in covariances.items():
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        flat = values <= FLAT * max(float(values[0]) if dim else 0.0, 0.0)
        scale = np.where(flat, 0.0, 1.0 / np.sqrt(np.where(flat, 1.0, values)))
        trace = float(np.trace(v))
        n, total = sums[dim]
        model[dim] = {"n": n, "sums": total, "centre": np.array([_ratio(s, n) for s in total]), "axes": axes * scale, "flat": flat,
                      "explained": np.where(flat, 0.0, values / trace if trace > 0 else 0.0)}
    return model


def _whiten(model: dict[int, dict]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch, "x", np.int64):
                m = model[x.shape[1]]
                white = (x - m["centre"]) @ m["axes"]
                part = batch.take(pa.array(at))
                ends = np.arange(len(at) + 1, dtype=np.int32) * white.shape[1]
                yield pa.record_batch({
                    "x": part.column("x"), "weight": part.column("weight"),
                    "deviation": pa.array(_deviations(x, m["n"], np.array(m["sums"], object)), _EXACT),
                    "white": pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))})

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           weighting: str = "count") -> DataFrame:
    """One row per whole vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Equal x vectors are grouped (summed on the map side, so a vector that a third of all
    rows repeat is one row per task). Sums, centred products and whitened values are
    computed once per distinct vector, weighted by its count, or by one with
    ``weighting="one"`` (then n counts distinct vectors). Rows get theirs by a join on x, a
    plain join of a side with unique keys that adaptive execution splits. The driver holds
    a covariance matrix and its eigenvectors, whose size is that of the vector squared.

    Rows with a null vector or entries that are null, not finite or of 1.4e17 and more (no
    x among the longs) are left out. Vectors of each length are fitted by themselves; empty
    ones have no component. With fewer dimensions than ``components`` there are as
    many as dimensions. A component without variance is no axis: its ``whitened`` is null,
    its ``explained`` 0, and it does not count for ``identity_error``. Repeated rows and
    null ids are kept; an empty table gives none. ``deviation`` is decimal(38,0).
    """
    if weighting not in ("count", "one"):
        raise ValueError("weighting is count or one")
    rows = integers(vectors, id_col, vector_col).filter(F.size("x") > 0)
    count = F.count("*") if weighting == "count" else F.lit(1).cast("long")
    distinct = stage(rows.groupBy("x").agg(count.alias("weight")), "distinct_vectors")
    sums = _sums(distinct, "x", np.int64)
    model = whitener(sums, _covariances(distinct, "x", np.int64, sums), components)
    # one row per distinct vector, written once: its covariance and all rows of the result come from it
    done = stage(distinct.mapInArrow(_whiten(model), "x array<long>, weight long, deviation decimal(38,0), white array<double>"),
                 "white_vectors")
    by_length = done.withColumn("dim", F.size("x"))
    errors = []
    for dim, m in model.items():
        own = by_length.filter(F.col("dim") == dim) if len(model) > 1 else by_length
        k = len(m["flat"])
        white = _covariances(own, "white", np.float64, _sums(own, "white", np.float64)).get(k, np.zeros((k, k))) if k else np.zeros((0, 0))
        live = np.flatnonzero(~m["flat"])
        off = np.abs(white - np.eye(k))[np.ix_(live, live)]
        errors.append((dim, m["n"], float(off.max(initial=0.0)), m["explained"].tolist(), m["flat"].tolist()))
    spark = vectors.sparkSession
    fits = spark.createDataFrame(
        errors, "dim int, n long, identity_error double, explained array<double>, flat array<boolean>") if errors else None
    if fits is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
                                         "explained double, identity_error double")
    # a row per length of vector, hence small
    parts = rows.join(done.select("x", "deviation", "white"), "x").withColumn("dim", F.size("x")).drop("x").join(F.broadcast(fits), "dim")
    return parts.select("*", F.posexplode("white").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.when(~F.get("flat", F.col("at")), F.col("value")).alias("whitened"),
        F.get("explained", F.col("at")).alias("explained"), "identity_error")


def whitening_report(vectors: DataFrame) -> DataFrame:
    """The operator's rows with ``deviation`` as long; null where a sum is beyond a long."""
    return whiten(vectors).withColumn("deviation", F.col("deviation").try_cast("long"))

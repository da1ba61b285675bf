"""Mixing sources to target weights by Pfair scheduling (operator 6)."""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

#: documents of a source that are scheduled together
BLOCK = 8
#: whole tickets that stand for all weights together; a mix is short against it, so that none is off by a block
PERIOD = 1 << 48
#: no longer a bound, every source is scheduled by itself; the name stays for those who set it
MAX_SOURCES = 512
#: target weight of a source without a given one: its share of documents to this power
EXPONENT = 0.7
#: documents that one task orders together, about
ORDERED_ROWS = 512


def deal(blocks: list[int], tickets: list[int]) -> np.ndarray:
    """Source of each of ``sum(blocks)`` slots, earliest deadline first; all numbers are above 0.

    In the ideal mix every source runs at its share of the tickets of those that are not yet
    used up; F(v) = sum of min(blocks, v tickets) slots are then over when a source with k
    tickets has had v k of its blocks. Block j of it is released at floor(F(j / k)) and due by
    ceil(F((j + 1) / k)). The ideal mix fills all slots and keeps to these windows, so that
    earliest deadline first does too: after any number of slots a source has had less than one
    block more or less than in the ideal mix. Whole numbers throughout, nothing is rounded.
    """
    shift = 2 * max(tickets).bit_length() + 2  # tells any two fractions over tickets apart
    ends = sorted(((n << shift) // k, n, k) for n, k in zip(blocks, tickets))
    at = [e for e, _, _ in ends]
    over = [0, *accumulate(n for _, n, _ in ends)]
    left = [*accumulate((k for _, _, k in reversed(ends)), initial=0)][::-1]

    def window_end(s: int, j: int) -> tuple[int, int]:
        k = tickets[s]
        gone = bisect_right(at, (j << shift) // k)
        whole, rest = divmod(j * left[gone], k)
        return over[gone] + whole, over[gone] + whole + (rest > 0)

    edge = [window_end(s, 1) for s in range(len(blocks))]  # of the block that is next
    had = [0] * len(blocks)
    future, ready = [(0, s) for s in range(len(blocks))], []
    out = np.empty(over[-1], np.int32)
    for t in range(over[-1]):
        while future and future[0][0] <= t:
            s = heapq.heappop(future)[1]
            heapq.heappush(ready, (edge[s][1], s))
        due, s = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a block missed its deadline")
        out[t] = s
        had[s] += 1
        if had[s] < blocks[s]:
            heapq.heappush(future, (edge[s][0], s))
            edge[s] = window_end(s, had[s] + 1)
    return out


def pfair(tickets: list[int]) -> list[int]:
    """Source of each of ``sum(tickets)`` slots: after any number t of them a source with k tickets
    has had less than one slot more or less than t k / Q, Q being their sum."""
    own = [s for s, k in enumerate(tickets) if k]
    return [own[i] for i in deal([tickets[s] for s in own], [tickets[s] for s in own]).tolist()] if own else []


def tickets_for(weights: list[float], period: int) -> list[int]:
    """Whole numbers near the weights with sum ``period``, one at least each (largest remainders)."""
    total = sum(weights)
    exact = [w / total * (period - len(weights)) for w in weights]
    out = [1 + int(x) for x in exact]
    order = sorted(range(len(exact)), key=lambda i: (int(exact[i]) - exact[i], i))
    for i in order[: period - sum(out)]:
        out[i] += 1
    return out


@dataclass
class Schedule:
    """The slots of each source's blocks, one source after the other, and the slots at which phases end."""

    sources: pd.Index
    first: np.ndarray
    slots: np.ndarray
    ends: np.ndarray


def schedule(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> Schedule:
    """Places all blocks. A phase ends as soon as a source is used up; the others share its weight."""
    names = sorted(s for s in blocks if blocks[s])
    if not names:
        return Schedule(pd.Index([], dtype=object), *[np.zeros(0, np.int64)] * 3)
    n = [blocks[s] for s in names]
    k = tickets_for([weights[s] for s in names], max(period, 8 * len(names)))
    line = deal(n, k)
    ends, over, left = [], 0, sum(k)
    for size, tickets in sorted(zip(n, k), key=lambda x: Fraction(*x)):
        ends.append(over + size * left // tickets)
        over, left = over + size, left - tickets
    first = np.cumsum([0, *n[:-1]])
    return Schedule(pd.Index(names, dtype=object), first, np.argsort(line, kind="stable"), np.unique(ends))


def slots_of(plan: Schedule, sources: pd.Series, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and phase of each given block of the source beside it."""
    slot = plan.slots[plan.first[plan.sources.get_indexer(sources)] + block]
    return slot, np.searchsorted(plan.ends, slot, side="right").astype(np.int32)


def slot_of(plan: Schedule, source: str, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and phase of the given blocks of a source."""
    return slots_of(plan, pd.Series([source] * len(block), dtype=object), block)


def _placed(ids: DataFrame, weights: dict[str, float] | None, block: int) -> DataFrame:
    """Adds block, in_block, slot and phase to (_row, source, ...); ``_row`` is unique."""
    counts = {r["source"]: r["count"] for r in ids.groupBy("source").count().collect()}
    total = sum(counts.values())
    targets = {s: (weights or {}).get(s, (n / total) ** EXPONENT) for s, n in counts.items()}
    if any(w <= 0 for w in targets.values()):
        raise ValueError("target weights must be above 0")
    plan = schedule({s: -(-n // block) for s, n in counts.items()}, targets)
    # the order within a source is random but fixed; it is ranked by ranges, so that no source meets in one task
    ranges = min(1 << 16, max(1, total // ORDERED_ROWS))
    keyed = ids.withColumn("_key", F.xxhash64("_row")).withColumn(
        "_range", F.floor((F.shiftrightunsigned("_key", 32) * ranges) / float(1 << 32)).cast("int"))
    sums = keyed.groupBy("source", "_range").agg(F.count("*").alias("_n"))
    base = sums.select("source", "_range", (F.sum("_n").over(
        Window.partitionBy("source").orderBy("_range")) - F.col("_n")).alias("_base"))
    ranked = (
        keyed.join(base, ["source", "_range"])
        .withColumn("_i", F.col("_base") + F.row_number().over(
            Window.partitionBy("source", "_range").orderBy("_key", "_row")) - 1)
        .withColumn("block", F.floor(F.col("_i") / block).cast("long"))
        .withColumn("in_block", F.pmod("_i", F.lit(block)).cast("int"))
        .drop("_key", "_range", "_base", "_i")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            slot, phase = slots_of(plan, pdf["source"], pdf["block"].to_numpy())
            yield pdf.assign(slot=slot, phase=phase)

    kept = [f"{n} {t}" for n, t in ranked.dtypes]
    return ranked.mapInPandas(run, ", ".join(kept) + ", slot long, phase int")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, source, block, in_block, slot, phase.

    Each source's documents, in a fixed random order, are dealt into blocks of ``block``;
    a block takes one slot of the mix. Slots are given out by earliest deadline first, so
    that in every prefix of the mix each source is within one block of what its weight gives
    it. A phase ends when a source has run out; then the weights of the others are scaled up.
    All documents are placed; phase 0 is the stretch at the target weights themselves. The
    schedule is listed on the driver, some twelve bytes a block.

    ``weights`` gives targets by source (any positive scale); a source without one gets
    its share of documents to the power 0.7. Every source has windows and blocks of its
    own, however many there are. A null source is the source "". Repeated rows
    and null ids are placed like any other row. Empty table: no rows. ``docs`` must be a
    stored table, so that its row numbers are the same when a task runs again.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                      F.monotonically_increasing_id().alias("_row"))
    return _placed(ids, weights, block).select("doc_id", "source", "block", "in_block", "slot", "phase")


def mixed_documents(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """All documents with their columns, sorted by their place in the mix."""
    row, slot, place = (unused(docs, n) for n in ("_row", "_slot", "_place"))
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    ids = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                      F.monotonically_increasing_id().alias("_row"))
    order = _placed(ids, weights, block).select(
        F.col("_row").alias(row), F.col("slot").alias(slot), F.col("in_block").alias(place))
    return (
        rows.join(order, row).repartitionByRange(slot, place).sortWithinPartitions(slot, place)
        .select(*docs.columns)
    )


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name

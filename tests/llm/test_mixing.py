"""The schedule against its definition, and mixes of whole tables."""

import random
from collections import Counter

import pytest

from strandlake.llm import mixing
from strandlake.llm.queries import op6_mixing


@pytest.mark.parametrize("seed", range(5))
def test_less_than_one_block_from_the_weights(seed):
    rng = random.Random(seed)
    tickets = [rng.randint(1, 60) for _ in range(rng.randint(1, 12))]
    line, q, had = mixing.pfair(tickets), sum(tickets), Counter()
    for t, s in enumerate(line, 1):
        had[s] += 1
        assert all(abs(had[k] * q - t * n) < q for k, n in enumerate(tickets))
    assert [had[k] for k in range(len(tickets))] == tickets


def test_tickets():
    assert mixing.tickets_for([1, 1, 2], 40) == [10, 10, 20] or sum(mixing.tickets_for([1, 1, 2], 40)) == 40
    small = mixing.tickets_for([1e-9, 1.0], 100)
    assert small == [1, 99]


def test_every_block_has_a_slot_of_its_own():
    blocks = {"a": 700, "b": 31, "c": 5}
    weights = {"a": 1.0, "b": 2.0, "c": 0.5}
    phases = mixing.schedule(blocks, weights, period=64)
    import numpy as np

    slots = [mixing.slot_of(phases, s, np.arange(n))[0] for s, n in blocks.items()]
    assert sorted(np.concatenate(slots).tolist()) == list(range(sum(blocks.values())))
    assert all((np.diff(x) > 0).all() for x in slots)


def test_query_places_all(spark, sf_dir):
    rows = op6_mixing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert sorted((r.doc_id, r.source) for r in rows) == sorted((r.doc_id, r.source) for r in docs)
    blocks = {}
    for r in rows:
        blocks.setdefault(r.slot, []).append((r.source, r.block, r.in_block))
    assert sorted(blocks) == list(range(len(blocks)))
    for members in blocks.values():
        assert len({m[:2] for m in members}) == 1 and sorted(m[2] for m in members) == list(range(len(members)))


def test_target_weights_hold_in_the_first_phase(spark):
    df = spark.createDataFrame([(i, "big" if i % 4 else "small") for i in range(4000)], "doc_id long, source string")
    rows = mixing.mix(df, {"big": 1.0, "small": 1.0}, block=4).collect()
    first = [r for r in rows if r.phase == 0]
    n = max(r.slot for r in first) + 1
    for t in (10, n // 2, n):
        had = len({r.slot for r in first if r.slot < t and r.source == "small"})
        assert abs(had - t / 2) < 1
    assert len({r.slot for r in rows if r.source == "small"}) == 250 and len(rows) == 4000


def test_odd_rows(spark):
    rows = [(None, None, "x"), (1, None, "y"), (1, "s", "z"), (1, "s", "z"), (2, "", "w")]
    df = spark.createDataFrame(rows, "doc_id long, source string, slot string")
    got = mixing.mix(df).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((a, b or "") for a, b, _ in rows)
    assert mixing.mix(df.limit(0)).count() == 0
    df = df.withColumnRenamed("slot", "_row").selectExpr("*", "'a' as _Slot", "1 as block")
    whole = mixing.mixed_documents(df)
    assert whole.columns == df.columns and sorted(map(str, whole.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError):
        mixing.mix(df, {"s": 0.0})


def test_mixed_documents_are_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = {r.doc_id: (r.slot, r.in_block) for r in mixing.mix(docs).collect()}
    order = [place[r.doc_id] for r in mixing.mixed_documents(docs).collect()]
    assert order == sorted(order) and len(order) == len(place)


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    df = spark.createDataFrame([(i, f"s{min(i % 10, 5)}") for i in range(300)], "doc_id long, source string")
    rows = mixing.mix(df, block=4).collect()
    assert Counter(r.source for r in rows) == Counter(r.source for r in df.collect())
    blocks = {}
    for r in rows:
        blocks.setdefault(r.slot, set()).add("rest" if r.source not in ("s5", "s0") else r.source)
    assert sorted(blocks) == list(range(len(blocks))) and all(len(b) == 1 for b in blocks.values())


def test_exact_weights_over_many_blocks():
    """Unequal weights, far beyond 4,096 slots: within one block of t * w in every prefix."""
    import numpy as np

    names = [f"s{i:02}" for i in range(21)]
    weights = dict(zip(names, [0.2] + [0.8 * k / 210 for k in range(1, 21)]))
    plan = mixing.schedule({s: int(40_000 * w) for s, w in weights.items()}, weights)
    until = int(plan.ends[0])
    assert until > 35_000
    for s, w in weights.items():
        slots, phase = mixing.slot_of(plan, s, np.arange(int(40_000 * w)))
        had = np.searchsorted(slots, np.arange(until + 1))
        assert abs(had - np.arange(until + 1) * w).max() < 1
        assert ((slots < until) == (phase == 0)).all()


def test_weights_are_shared_when_a_source_ends():
    import numpy as np

    plan = mixing.schedule({"a": 10, "b": 400, "c": 90}, {"a": 0.2, "b": 0.5, "c": 0.3})
    assert [round(e, -1) for e in plan.ends.tolist()] == [50, 250, 500]
    one, two = int(plan.ends[0]), int(plan.ends[1])
    had = np.searchsorted(mixing.slot_of(plan, "b", np.arange(400))[0], np.arange(two + 1))
    ideal = np.where(np.arange(two + 1) <= one, 0.5 * np.arange(two + 1), 0.5 * one + (np.arange(two + 1) - one) * 5 / 8)
    assert abs(had - ideal).max() < 1


def test_weights_hold_beyond_512_sources(spark):
    """A weight of one of 700 small sources counts, and no block holds two sources."""
    rows = [(i, f"s{i % 600:03}") for i in range(3600)] + [(3600 + i, f"t{i % 100:02}") for i in range(100)]
    rows += [(4000 + i, "t00") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(df, {"t00": 5.0, "s000": 5.0} | {s: 0.01 for _, s in rows if s not in ("t00", "s000")}, block=1).collect()
    assert Counter(r.source for r in got) == Counter(s for _, s in rows)
    assert len({r.slot for r in got}) == len(rows)
    assert {r.source for r in got if r.slot < 6 and r.phase == 0} >= {"t00", "s000"}
    assert max(r.slot for r in got if r.source == "t00") < 12
    blocks = {}
    for r in mixing.mix(df, block=4).collect():
        blocks.setdefault(r.slot, set()).add(r.source)
    assert sorted(blocks) == list(range(len(blocks))) and all(len(b) == 1 for b in blocks.values())

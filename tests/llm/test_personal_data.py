"""Personal data beside the plain patterns and a plain scoring of contexts; odd rows."""

import collections
import hashlib
import random
import re

from strandlake.llm import personal_data as pd_

BASE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")),
    ("card", re.compile(r"[0-9](?:[\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]
SCHEMA = "doc_id long, text string, kind string, spans int, mark long"


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text):
    spans = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE) for m in p.finditer(text or "") if holds(kind, m.group())]
    return [(BASE[k][0], s, e) for s, k, e in sorted(spans)]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def rows_of(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    return docs, pd_.find_personal_data(docs, **how).collect()


def test_base_equals_the_plain_patterns(spark):
    rng = random.Random(5)
    parts = list("ab.-_%+@@.. ()059") + ["a@b.c", "a.b@c-d.ef", "1.2.3.4", "256.1.1.1", "010.0.0.00255", "4111 1111 1111 1111",
                                        "4111-1111-1111-1112", "+1 (017) 555-7713", "+49 30 1234567", "é", "漢", "😀", "\n", ".@d.e", "x_y@z.w"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for k in range(1500)]
    rows += [(5000, "a" * 2000), (5001, "7" * 2000), (5002, "+1" + " " * 2000 + "x"), (5003, "1 " * 1000 + "a@b.c"),
             (5004, "12.34." * 700), (5005, "a@b" * 700)]
    docs, got = rows_of(spark, rows)
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert [(s["kind"], s["start"], s["end"]) for s in r.spans if s["base"]] == plain_base(text[r.doc_id]), rows[r.doc_id]
    report = {r.doc_id: r for r in pd_.personal_data_report(docs).collect()}
    for k, t in rows:
        want = plain_base(t)
        kinds = collections.Counter(x[0] for x in want)
        r = report[k]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[x] for x in pd_.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert r.n_found > 0 or r.spans == joined(want)


def plain_rounds(edges, rounds=pd_.ROUNDS):
    """Instance -> (kind, belief) by loops over edges (pattern, instance, kind, may)."""
    of = collections.defaultdict(list)
    for pattern, instance, kind, may in edges:
        of[pattern].append((instance, kind, may))
    named = {}
    for _ in range(rounds):
        beliefs = collections.defaultdict(lambda: 1.0)
        for members in of.values():
            sums, support, open_, decided = collections.Counter(), collections.Counter(), 0, 0.0
            for instance, kind, _ in members:
                label, weight = (kind, 1.0) if kind else named.get(instance, (None, 0.0))
                open_ += label is None
                decided += weight
                sums[label] += weight
                support[label] += 1
            for kind in pd_.KINDS:
                score = sums[kind] / (decided + pd_.UNDECIDED * open_ + 1)
                if support[kind] >= pd_.SUPPORT and score >= pd_.BELIEVED:
                    for instance, own, may in members:
                        if own is None and kind in may.split():
                            beliefs[instance, kind] *= 1 - score
        fresh = {}
        for (instance, kind), rest in sorted(beliefs.items(), key=lambda x: (x[1], x[0][1])):
            if 1 - rest >= pd_.BELIEVED:
                fresh.setdefault(instance, (kind, 1 - rest))
        if not fresh or fresh.keys() == named.keys() and all(fresh[i][0] == named[i][0] for i in fresh):
            return fresh or named
        named = fresh
    return named


def corpus():
    rng = random.Random(11)
    words = ["oak", "river", "stone", "cloud", "harbor", "meadow", "lantern", "copper"]
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    phone = lambda: f"+1 (0{rng.randrange(10, 99)}) 555-{rng.randrange(1000, 9999)}"
    local = lambda: f"0{rng.randrange(10, 99)} 555-{rng.randrange(1000, 9999)}"
    mail = lambda: f"{rng.choice(words)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"
    odd = lambda: f"{rng.choice(words)}{rng.randrange(999)} (at) example (dot) org"
    rows = []
    for _ in range(12):
        rows.append(f"{noise(9)} reach me at {phone()} {noise(4)}")
        rows.append(f"{noise(5)} write to {mail()} {noise(3)}")
        rows.append(f"{noise(5)} in the year {rng.randrange(1900, 2020)} {noise(3)}")
    found = []
    for _ in range(5):
        found += [local(), odd()]
        rows.append(f"{noise(6)} reach me at {found[-2]}, {noise(5)}")
        rows.append(f"{noise(6)} write to {found[-1]} {noise(5)}")
    # the second round: contexts that only the identifiers just found support
    for x in found[::2]:
        rows.append(f"{noise(5)} ring office desk {x}, {noise(2)}")
    late = [local() for _ in range(2)]
    rows += [f"{noise(5)} ring office desk {x}, {noise(2)}" for x in late]
    rows += [f"{noise(5)} order number {rng.randrange(10**7, 10**8)} {noise(3)}" for _ in range(6)]
    rows += [f"{noise(5)} in the year 5551234 {noise(2)}"]
    return list(enumerate(rows)), found, late


def test_contexts_find_what_no_pattern_describes(spark):
    rows, found, late = corpus()
    docs, got = rows_of(spark, rows)
    text = dict(rows)
    extra = collections.defaultdict(set)
    for r in got:
        for s in r.spans:
            if not s["base"]:
                extra[s["kind"]].add(text[r.doc_id][s["start"] : s["end"]])
    assert extra == {"phone": set(found[::2]) | set(late), "email": set(found[1::2])}
    _, one = rows_of(spark, rows, rounds=1)
    assert not {text[r.doc_id][s["start"] : s["end"]] for r in one for s in r.spans if not s["base"]} & set(late)


def test_rounds_equal_plain_scoring(spark):
    rows, _, _ = corpus()
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    _, found = pd_.mentions(docs)
    edges = pd_.graph(found)
    want = plain_rounds([tuple(r) for r in edges.select("pattern", "instance", "kind", "may").collect()])
    got = {r["instance"]: (r["named"], r["belief"]) for r in pd_.discover(edges).collect()}
    assert got.keys() == want.keys() and got
    for k, (kind, belief) in want.items():
        assert got[k][0] == kind and abs(got[k][1] - belief) < 1e-9


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (3, "x 1.2.3.4"), (None, "a@b.c"), (None, None)]
    docs, got = rows_of(spark, rows)
    assert sorted((str(r.doc_id), joined([(s["kind"], s["start"], s["end"]) for s in r.spans])) for r in got) == sorted(
        [("1", ""), ("2", ""), ("3", "email:0:5"), ("3", "email:0:5"), ("3", "ip:2:9"), ("None", "email:0:5"), ("None", "")])
    assert pd_.find_personal_data(docs.limit(0)).count() == 0
    report = pd_.personal_data_report(docs).collect()
    assert {r.base_sha256 for r in report if r.doc_id in (1, 2)} == {hashlib.sha256(b"").hexdigest()}


def test_long_runs(spark):
    n = 100_000
    _, got = rows_of(spark, [(1, "a" * n), (2, "7" * n), (3, "+1" + " " * n + "x"), (4, "1 " * n + "a@b.c"), (5, "12.34." * n)])
    assert {r.doc_id: len(r.spans) for r in got} == {1: 0, 2: 0, 3: 0, 4: 1, 5: n // 2}


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = pd_.personal_data_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_whole_table_by_plain_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = pd_.personal_data_report(docs).collect()
    assert len(rows) == len(text) and any(r.spans for r in rows)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(joined(plain_base(text[r.doc_id])).encode()).hexdigest()

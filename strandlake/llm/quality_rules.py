"""Quality rules whose cutoffs keep false rejections within a proven limit (operator 5)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .textkit import IS_LEAD, IS_SPACE, SpanHash, Texts, is_held_out, mix, per_text, slices

#: at most this share of the good documents of a stratum is rejected by all rules together ...
FALSE_REJECTION = 0.05
#: ... with this confidence for all strata and rules at once
CONFIDENCE = 0.95
#: a rule's measure, 0 to 1, is cut at multiples of 1 / STEPS
STEPS = 200
#: measure of each rule, the higher the worse
RULES = ("symbol_share", "repeat_share", "upper_share", "mark_share")
#: words of a window that counts as repeated
WINDOW = 5

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))  # fixed values: [#*$%&|<>]
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_MARK = np.isin(np.arange(256), list(b"!|"))

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_marks long"


def _seen_before(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key of a text: whether an equal one stands before it, and whether another one stands anywhere."""
    order = np.lexsort((np.arange(len(keys)), keys, docs))
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = (keys[order][1:] == keys[order][:-1]) & (docs[order][1:] == docs[order][:-1])
    before, anywhere = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order] = same[:-1]
    anywhere[order] = same[:-1] | same[1:]
    return before, anywhere


def text_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text of a slice."""
    n = texts.count
    ws, we, wd = texts.words()
    spans = SpanHash(texts.data)

    def total(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(mask[texts.data])])
        return (c[texts.ends] - c[texts.starts]).astype(np.int64)

    ls, le, ld = texts.lines()
    word_at = np.searchsorted(ws, ls)
    worded = np.searchsorted(ws, le) > word_at
    again, _ = _seen_before(spans.of(ls, le), ld)
    wh = spans.of(ws, we)
    m = max(0, len(wh) - WINDOW + 1)
    key = np.zeros(m, np.uint64)
    for k in range(WINDOW):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wh[k : k + m])
    whole = wd[:m] == wd[WINDOW - 1 :] if m else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    _, twice = _seen_before(key[at], wd[at])
    cover = np.zeros(len(wh) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    return {
        "n_words": np.bincount(wd, minlength=n).astype(np.int64),
        "word_chars": total(IS_LEAD & ~IS_SPACE),
        "n_symbols": total(_SYMBOL),
        "n_dup_lines": per_text(worded & again, ld, n),
        "n_repeat_words": per_text(np.cumsum(cover)[:-1] > 0, wd, n),
        "n_upper": total(_UPPER),
        "n_marks": total(_MARK),
    }


def counted(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the counts of each whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
                       F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.record_batch({"doc_id": part.column("doc_id"), "stratum": part.column("stratum"),
                                       **text_counts(Texts(part.column("text")))})

    return rows.mapInArrow(run, f"doc_id long, stratum string, {COUNTS}")


def measures(counts: DataFrame) -> DataFrame:
    """Adds base_failed and the measure of each rule as a step number from 0 to STEPS."""
    share = {
        "symbol_share": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
        "upper_share": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
        "mark_share": F.col("n_marks") / F.greatest("word_chars", F.lit(1)),
    }
    step = {k: F.least(F.floor(v * STEPS), F.lit(STEPS)).cast("int").alias(k) for k, v in share.items()}
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.select("*", failed.alias("base_failed"), *[step[r] for r in RULES])


def binomial_below(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p); exact up to rounding. The terms fall from k downwards if k < n p."""
    if k >= n:
        return 1.0
    if k >= n * p:  # sum the other tail, whose terms fall from k + 1 upwards
        term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 2) - math.lgamma(n - k) + (k + 1) * math.log(p)
                        + (n - k - 1) * math.log1p(-p))
        total, i = 0.0, k + 1
        while i <= n and term > 1e-18 * total:
            total += term
            term *= (n - i) / (i + 1) * p / (1 - p)
            i += 1
        return max(0.0, 1.0 - total)
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p)
                    + (n - k) * math.log1p(-p))
    total, i = 0.0, k
    while i >= 0 and term > 1e-18 * total:
        total += term
        term *= i / max(1, n - i + 1) * (1 - p) / p
        i -= 1
    return min(1.0, total)


def strictest(rejected: np.ndarray, n: int, limit: float, error: float) -> int | None:
    """The lowest step that may serve as cutoff, or None.

    ``rejected[c]`` of the n good documents lie at step c or above. From the highest step
    down each cutoff is tested against "more than ``limit`` of the good ones are rejected"
    until one test fails; in a fixed order each may use the whole ``error``.
    """
    best = None
    for c in range(len(rejected) - 1, 0, -1):
        if not n or binomial_below(int(rejected[c]), n, limit) > error:
            break
        best = c
    return best


def cutoffs(rows: DataFrame, labels: DataFrame, limit: float = FALSE_REJECTION,
            confidence: float = CONFIDENCE) -> tuple[list[str], dict[str, dict[str, int]]]:
    """The strata with labels, most first, and the cutoff of each stratum and rule, from good documents outside the held-out rows that pass the base rules.

    The limit is shared among the rules, the error among all strata and rules (Bonferroni).
    Only counts by stratum, rule and step reach the driver.
    """
    good = (
        labels.filter(F.col("doc_id").isNotNull() & (F.col("quality") == 1) & ~is_held_out(F.col("doc_id").cast("long")))
        .select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    )
    known = rows.filter(~F.col("base_failed")).select("doc_id", "stratum", *RULES).join(good, "doc_id")
    sizes = known.groupBy("stratum").count().orderBy(F.desc("count"), "stratum").collect()
    named = [r["stratum"] for r in sizes]
    long = known.select("stratum", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES])).alias("m")).select("stratum", "m.*")
    tables: dict[tuple[str, str], np.ndarray] = {}
    for r in long.groupBy("stratum", "rule", "step").count().collect():
        tables.setdefault((r["stratum"], r["rule"]), np.zeros(STEPS + 1, np.int64))[r["step"]] = r["count"]
    out: dict[str, dict[str, int]] = {}
    for (stratum, rule), hist in tables.items():
        rejected = hist[::-1].cumsum()[::-1]
        cut = strictest(rejected, int(hist.sum()), limit / len(RULES), (1 - confidence) / len(tables))
        if cut is not None:
            out.setdefault(stratum, {})[rule] = cut
    return named, out


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = FALSE_REJECTION,
                confidence: float = CONFIDENCE) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, failed_rules (names).

    Measures are computed on whole texts; a document that fails a base rule is not kept,
    any other is kept unless a measure reaches the cutoff of its stratum. Cutoffs are the
    strictest for which exact binomial tests on labelled good documents show that all
    rules together reject at most ``limit`` of the good ones of that stratum, with
    ``confidence`` for all strata at once. A stratum with too few labels gets no cutoff.

    Null and empty texts count no words and fail the base rules. A null stratum is the
    stratum "". Without labels only the base rules act. Repeated rows are judged alike.
    Empty table: no rows.
    """
    rows = measures(stage(counted(docs, stratum), "rule-counts"))
    _, found = cutoffs(rows, labels, limit, confidence)
    if found:  # a stored table, so that its size is known to the join
        cuts = docs.sparkSession.createDataFrame(
            [(s, *map(c.get, RULES)) for s, c in sorted(found.items())], ", ".join(["stratum string", *[f"cut_{r} int" for r in RULES]]))
        rows = rows.join(stage(cuts.coalesce(1), "cutoffs"), "stratum", "left")

    def broken(rule: str) -> Column:
        cut = F.col(f"cut_{rule}") if found else F.lit(None).cast("int")
        return F.when(F.col(rule) >= cut, F.lit(rule))

    return (
        rows.withColumn("failed_rules", F.array_compact(F.array(*map(broken, RULES))))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules")
    )

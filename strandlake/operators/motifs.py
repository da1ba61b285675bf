"""Sequence content and short-word enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arith import col, idiv
from ..functions.names import reverse_complement
from ..functions.ranking import running_total
from ..functions.stats import binomial_score
from ..functions.tiling import tile_range
from ..session import stage
from .intervals import place_keys


def gc_share(seq: str | Column) -> Column:
    s = col(seq)
    return F.length(F.regexp_replace(s, "[^GCgc]", "")) / F.nullif(F.length(s), F.lit(0))


def peak_sequences(peaks: DataFrame, sequences: DataFrame, chunk: int, ids: Sequence[str]) -> DataFrame:
    """Reference sequence of each interval, put together from chunks of fixed size.

    ``sequences`` has (chrom, off, seq) with off a multiple of ``chunk``; a chunk may
    carry bases of the next one, which are not used here. The bases gathered per row
    are those of one interval. Where both tables name the genome, it is part of the place.
    """
    place = place_keys(peaks, sequences)
    part = sequences.select(*place, idiv("off", chunk).alias("piece"), F.col("off"), F.substring("seq", 1, chunk).alias("seq"))
    lo = F.greatest(F.col("s"), F.col("off"))
    hi = F.least(F.col("e"), F.col("off") + F.length("seq"))
    cut = F.substring(F.col("seq"), (lo - F.col("off") + 1).cast("int"), (hi - lo).cast("int"))
    pieces = (
        peaks.select(*ids, *place, "s", "e", F.explode(tile_range("s", "e", chunk)).alias("piece"))
        .join(part, [*place, "piece"])
        .select(*ids, *place, "s", "e", F.struct("off", cut.alias("bases")).alias("x"))
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bases"]), "")
    return pieces.groupBy(*ids, *place, "s", "e").agg(text.alias("seq"))


def gc_profile(intervals: DataFrame, sequences: DataFrame, chunk: int, bins: int = 20) -> DataFrame:
    """Histogram of the GC share of fragments; equal fragments are looked up once."""
    distinct = intervals.groupBy("sample", *place_keys(intervals, sequences), "s", "e").agg(F.count(F.lit(1)).alias("n"))
    found = peak_sequences(distinct, sequences, chunk, ["sample", "n"])
    return found.groupBy("sample", F.floor(gc_share("seq") * bins).alias("gc_bin")).agg(F.sum("n").alias("n"))


def background_regions(targets: DataFrame, candidates: DataFrame, ratio: int = 2, seed: int = 0) -> DataFrame:
    """From each GC bin of the targets, ``ratio`` times as many candidates, in order of a hash of their id.

    Both tables have (id, seq). Candidates are ranked by ranges of the hash, so a GC
    bin is never ordered as a whole.
    """
    gc = F.floor(gc_share("seq") * 20).alias("gc_bin")
    need = targets.groupBy(gc).agg((F.count(F.lit(1)) * ratio).alias("need"))
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    ranged = candidates.select("*", gc, mark.alias("_mark")).withColumn("_part", F.substring("_mark", 1, 3))
    ranked = running_total(ranged, ["gc_bin"], "_part", [F.col("_mark"), F.col("id")], F.lit(1).cast("bigint"), "rank")
    return ranked.join(need, "gc_bin").filter("rank <= need").drop("_mark", "_part", "need")


def kmers(seq: str | Column, k: int) -> Column:
    """Distinct words of length k on either strand, each as the lesser of itself and its reverse complement."""
    s = col(seq)
    starts = F.sequence(F.lit(1), F.length(s) - k + 1)
    words = F.transform(starts, lambda i: F.substring(s, i, F.lit(k)))
    both = F.transform(words, lambda w: F.least(w, reverse_complement(w)))
    return F.when(F.length(s) >= k, F.array_distinct(both)).otherwise(F.array().cast("array<string>"))


def motif_counts(seqs: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """Number of sequences that hold each word; repeats inside a sequence count once."""
    return seqs.select(F.explode(kmers(seq, k)).alias("kmer")).groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))


def motif_enrichment(targets: DataFrame, background: DataFrame, k: int, keys: Sequence[str] = ()) -> DataFrame:
    """All words more frequent in the targets than in the background, ranked by binomial tail, then by word.

    With ``keys`` (sample, parameter set) each value has its own targets, background and
    ranks; one without any background sequence is compared with a share of one half. Both
    sides are counted in one pass.
    """
    by = list(keys)
    both = targets.select(*by, "seq", F.lit(1).alias("target")).unionByName(background.select(*by, "seq", F.lit(0).alias("target")))
    words = both.select(*by, "target", F.explode(F.concat(kmers("seq", k), F.array(F.lit("")))).alias("kmer"))  # "" counts the sequence
    counts = stage(words.groupBy(*by, "kmer").agg(
        F.sum("target").alias("n"), F.sum(1 - F.col("target")).alias("background_hits")), "words")
    all_of = counts.filter("kmer = ''").select(*by, F.col("n").alias("targets"), F.col("background_hits").alias("others"))
    found = counts.filter("kmer <> '' and n > 0")
    if by:
        found = found.join(all_of, by)
    else:
        found = found.withColumns({c: all_of.select(c).scalar() for c in ("targets", "others")})
    scored = (
        found.withColumn("share", (F.col("background_hits") + 1) / (F.col("others") + 2))
        .filter(F.col("n") > F.col("targets") * F.col("share"))
        .withColumn("score", binomial_score(F.col("n"), F.col("targets"), F.col("share")))
    )
    of = F.round("score", 9)
    ranged = stage(scored.withColumn("all", F.lit(0)).withColumn("at", F.floor(of * 16)), "scored-words")
    ranked = running_total(ranged, ["all", *by], "at", [of.desc(), F.col("kmer")], F.lit(1).cast("bigint"), "rank", down=True)
    return ranked.select(*by, "rank", "kmer", F.col("n").alias("hits"), "background_hits", "score")


def motif_information(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """Information content in bits at each position of aligned sequences, with the base shares."""
    letters = F.filter(F.split(F.upper(seq), ""), lambda c: c != "")
    at = seqs.select(F.posexplode(letters).alias("pos", "base")).filter(F.col("base").isin("A", "C", "G", "T"))
    share = {b: F.count_if(F.col("base") == b) / F.count(F.lit(1)) for b in "ACGT"}
    shares = at.groupBy("pos").agg(*[c.alias(b) for b, c in share.items()])
    bits = F.lit(2.0)
    for b in "ACGT":
        bits = bits + F.when(F.col(b) > 0, F.col(b) * F.log2(b)).otherwise(0.0)
    return shares.withColumn("bits", bits)

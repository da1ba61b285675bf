"""Placing reads on sequences by shared seeds: ungapped, up to a number of mismatches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arith import (
    MATE_1, MATE_2, MATE_REVERSE, MATE_UNMAPPED, PAIRED, PROPER, REVERSE, UNMAPPED, idiv,
)
from ..functions.names import reverse_complement
from ..session import stage


WORD = 31  # bases per 64-bit word, two bits each
_ALL = (1 << 2 * WORD) - 1
#: bases of the first seeds at most, and by how many they are lengthened where they are frequent
SEED, LONGER = 14, 4
#: a seed at more places is lengthened, as far as the reads' parts reach
MANY_PLACES = 1000
#: a seed is long enough if this many bases of the reference, on average, come to one of its codes
PLACES = 64
#: parts that are looked up together at most, where one part is too short
TOGETHER = 4


def _words(text: Column) -> Column:
    """The bases as an array of words of two-bit codes, each with a word that marks letters other than ACGT.

    The first base stands highest; the last word is filled up with marked bases.
    """
    def word(i: Column) -> Column:
        part = F.rpad(F.regexp_replace(F.substring(text, i * WORD + 1, F.lit(WORD)), "[^ACGT]", "N"), WORD, "N")
        return F.named_struct(F.lit("c"), F.conv(F.translate(part, "ACGTN", "01230"), 4, 10).cast("bigint"),
                              F.lit("x"), F.conv(F.translate(part, "ACGTN", "00001"), 4, 10).cast("bigint"))

    return F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / WORD).cast("int")), word)


def _left(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits.cast("int")).bitwiseAND(F.lit(_ALL))


def _right(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits.cast("int"))


def _across(first: Column, second: Column, r: Column) -> Column:
    """The word that begins ``r`` bases into the first of two neighbouring words."""
    return _left(first, 2 * r).bitwiseOR(_right(second, 2 * (WORD - r)))


def _differing(a: Column, b: Column) -> Column:
    """A bit for each base in which two words differ."""
    x = a.bitwiseXOR(b)
    return x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x1555555555555555))


def _first_bases(n: Column) -> Column:
    """A bit for each of the first ``n`` bases of a word."""
    return F.conv(F.concat(F.repeat(F.lit("1"), n.cast("int")), F.repeat(F.lit("0"), (WORD - n).cast("int"))), 4, 10).cast("bigint")


def packed(sequences: DataFrame) -> DataFrame:
    """(chrom, off, size, w): each piece of the reference once, as words of ``WORD`` bases."""
    pieces = sequences.select("chrom", F.col("off").cast("bigint").alias("off"), F.upper("seq").alias("seq")).filter(F.length("seq") > 0)
    once = pieces.groupBy("chrom", "off").agg(F.max_by("seq", F.length("seq")).alias("seq"))  # of pieces from one place, the longest
    return once.select("chrom", "off", F.length("seq").alias("size"), _words(F.col("seq")).alias("w"))


def positions(pieces: DataFrame) -> DataFrame:
    """A row per base of the packed reference: piece, at (in its piece), right, left, odd.

    right: the word of bases from there on, left: the word of those before, odd: marks of the
    former. All three are numbers, however long the reads are.
    """
    none = F.named_struct(F.lit("c"), F.lit(0).cast("bigint"), F.lit("x"), F.lit(_ALL // 3).cast("bigint"))
    cells = F.transform(
        F.sequence(F.lit(0), F.size("w") - 1),
        lambda i: F.struct(i.alias("i"), F.coalesce(F.get("w", i - 1), none).alias("a"), F.get("w", i).alias("b"),
                           F.coalesce(F.get("w", i + 1), none).alias("c")))
    rows = pieces.select("piece", F.inline(cells)).select("*", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))).alias("r"))
    r = F.col("r")
    return rows.select(
        "piece", (F.col("i") * WORD + r).alias("at"), _across(F.col("b.c"), F.col("c.c"), r).alias("right"),
        _across(F.col("a.c"), F.col("b.c"), r).alias("left"), _across(F.col("b.x"), F.col("c.x"), r).alias("odd"))


def _code(word: Column, k: int) -> Column:
    """The first k bases of a word."""
    return F.shiftright(word, 2 * (WORD - k))


def _levels(shortest: int, longest: int) -> list[int]:
    """Lengths of seeds, from the first ones to the longest that a part of some read holds."""
    levels = [min(shortest, SEED)]
    while levels[-1] < min(longest, WORD):
        levels.append(min(levels[-1] + LONGER, longest, WORD))
    return levels


def _on_forward() -> Column:
    """The text as it would lie on the forward strand."""
    return F.when(F.col("strand") == "-", reverse_complement("seq")).otherwise(F.col("seq"))


def _together(length: Column, max_mismatch: int, bases: int) -> Column:
    """(k, part): the fewest parts looked up together that have so many bases, else those that have the most.

    Of m + k parts, k at least are without a mismatch. Two parts and more lie in the first word.
    """
    ways = [(k, F.floor((length if k == 1 else F.least(length, F.lit(WORD))) / (max_mismatch + k)).cast("int"))
            for k in range(1, TOGETHER + 1)]
    rank = F.greatest(*(F.struct(F.least(k * part, F.lit(bases)).alias("held"), F.lit(-k).alias("k"), part.alias("part")) for k, part in ways))
    return F.struct((-rank["k"]).alias("k"), rank["part"].alias("part"))


def _shapes(k: int, max_mismatch: int) -> list[tuple[int, ...]]:
    """Choices of k of m + k parts, by the distances from the first one chosen."""
    return sorted({tuple(x - c[0] for x in c) for c in combinations(range(max_mismatch + k), k)})


def _shape_code(word: Column, part: int, parts: Sequence[int]) -> Column:
    """The bases of the given parts of a word, one after the other."""
    code = F.lit(0).cast("bigint")
    for i in parts:
        code = F.shiftleft(code, 2 * part).bitwiseOR(
            F.shiftright(word, 2 * (WORD - (i + 1) * part)).bitwiseAND(F.lit((1 << 2 * part) - 1)))
    return code


def _shape_mask(part: int, parts: Sequence[int]) -> int:
    return sum(((1 << 2 * part) - 1) << 2 * (WORD - (i + 1) * part) for i in parts)


def _oriented(texts: DataFrame, parts: Column) -> DataFrame:
    """Each text in both directions: one row for each of its ``parts``, with the words beside the part's beginning.

    texts: seq, k, part.
    """
    turned = texts.select("seq", F.length("seq").alias("len"), "k", "part", F.explode(F.array(F.lit("+"), F.lit("-"))).alias("strand"), parts.alias("n"))
    turned = turned.withColumn("q", _on_forward())
    begin = F.col("begin")
    before = F.least(begin, F.lit(WORD))
    return (
        turned.select("seq", "len", "strand", "q", "k", "part",
                      F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i * F.col("part"))).alias("begin"))
        .select(
            "seq", "len", "strand", "q", "k", "part", "begin",
            _words(F.substring(F.col("q"), begin + 1, F.lit(WORD)))[0].alias("from_here"),
            # bases before the part, the last one lowest as in the reference
            F.when(begin > 0, _right(_words(F.substring(F.col("q"), begin - before + 1, before))[0]["c"], 2 * (WORD - before)))
            .otherwise(0).alias("q_left"),
            _right(F.lit(_ALL // 3), 2 * (WORD - before)).alias("left_mask"),
            _first_bases(F.least(F.col("len") - begin, F.lit(WORD))).alias("right_mask"))
        .select("*", F.col("from_here.c").alias("q_right"), F.col("from_here.x").alias("q_odd")).drop("from_here")
    )


def _met(asked: DataFrame, here: DataFrame, on: Sequence[str], max_mismatch: int) -> DataFrame:
    """Candidates (seq, strand, piece, start) of texts and positions with one code, as far as the words beside it agree.

    Sorted and merged by hint: Spark takes rows made of a few bytes each for those bytes, and would
    send all positions through the driver.
    """
    return asked.join(here.hint("merge"), list(on)).filter(_near(max_mismatch)).select(
        "seq", "strand", "piece", (F.col("at") - F.col("begin")).alias("start"))


def _by_part(texts: DataFrame, listed: DataFrame, max_mismatch: int) -> list[DataFrame]:
    """Candidates of texts of which a single part is looked up; a frequent seed is lengthened as far as the part reaches."""
    span = texts.agg(F.min("part"), F.max("part")).first()
    if span[0] is None:
        return []
    levels = _levels(*map(int, span))
    wanted = _oriented(texts, F.lit(max_mismatch + 1)).filter(~F.substring(F.col("q"), F.col("begin") + 1, F.col("part")).rlike("[^ACGT]")).drop("q", "k", "len", "q_odd")
    found = []
    if len(levels) > 1:
        listed, wanted = stage(listed, "positions"), stage(wanted, "parts")
    for n, k in enumerate(levels):
        here = listed.filter(_code(F.col("odd"), k) == 0).withColumn("code", _code(F.col("right"), k))
        asked = wanted.withColumn("code", _code(F.col("q_right"), k))
        if n + 1 < len(levels):
            often = stage(here.groupBy("code").agg(F.count("*").alias("n")).filter(F.col("n") > MANY_PLACES).select("code"), "frequent")
            asked = asked.join(often.withColumn("often", F.lit(True)), "code", "left")
            further = F.coalesce("often", F.lit(False)) & (F.col("part") >= levels[n + 1])
            wanted = asked.filter(further).select(*wanted.columns)
            asked = asked.filter(~further)
            listed = here.join(often, "code", "left_semi").select(*listed.columns)
        found.append(_met(asked, here.drop("odd"), ["code"], max_mismatch))
    return found


def _by_shape(texts: DataFrame, listed: DataFrame, max_mismatch: int) -> list[DataFrame]:
    """Candidates of texts of which k parts are looked up together, by their distances."""
    kinds = sorted(map(tuple, texts.select("k", "part").distinct().collect()))  # a handful: part is under a word's length
    shapes = [(k, part, shape) for k, part in kinds for shape in _shapes(k, max_mismatch)]
    if not shapes:
        return []

    def coded(df: DataFrame, word: str, odd: str, fits: list[Column]) -> DataFrame:
        cells = [F.when(fit & (F.col(odd).bitwiseAND(F.lit(_shape_mask(part, shape))) == 0),
                        F.struct(F.lit(n).alias("shape"), _shape_code(F.col(word), part, shape).alias("code")))
                 for n, ((_, part, shape), fit) in enumerate(zip(shapes, fits))]
        return df.select("*", F.inline(F.array_compact(F.array(*cells)))).drop(odd)

    here = coded(listed, "right", "odd", [F.lit(True)] * len(shapes))
    wanted = _oriented(texts, F.lit(max_mismatch + 1))
    fits = [(F.col("k") == k) & (F.col("part") == part) & (F.col("begin") <= (max_mismatch + k - 1 - shape[-1]) * part)
            for k, part, shape in shapes]
    asked = coded(wanted, "q_right", "q_odd", fits).drop("q", "k", "part", "len")
    return [_met(asked, here, ["shape", "code"], max_mismatch)]


def text_hits(texts: DataFrame, sequences: DataFrame, max_mismatch: int = 2) -> DataFrame:
    """All places (seq, strand, chrom, pos, len, nm) of distinct texts with at most so many mismatches; a written table.

    A text with at most m mismatches agrees with its place in at least one of m + 1 parts. Its
    parts' first bases are looked up in a table of seeds and positions. A seed at more than
    ``MANY_PLACES`` places is lengthened step by step, as far as the part reaches; only
    positions of frequent seeds are listed again under the longer one. Where such a part is short
    beside the reference, so that a code would stand for more than ``PLACES`` places, k of m + k
    parts are looked up together: the text agrees in k of them, so the codes grow with the
    reference and the candidates in proportion to texts and positions. A position carries
    the words beside it, which settle most candidates at once; what is left is verified
    in the packed piece of the reference. A text with fewer bases than parts has no place.
    """
    seeds = max_mismatch + 1
    texts = texts.select(F.upper("seq").alias("seq")).filter(F.length("seq") >= seeds).distinct()
    # texts and pieces are few bytes but much work: they are not left to be merged into a few tasks by size
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = stage(packed(sequences).repartition(tasks).withColumn("piece", F.monotonically_increasing_id()), "reference")
    bases, size = 1, (pieces.agg(F.sum("size")).first()[0] or 0) / PLACES
    while 4 ** bases < size:
        bases += 1
    spread = stage(texts.repartition(tasks).select("seq", _together(F.length("seq"), max_mismatch, bases).alias("way")).select("seq", "way.*"), "texts")
    listed = positions(pieces)
    found = _by_part(spread.filter("k = 1"), listed, max_mismatch) + _by_shape(spread.filter("k > 1"), listed, max_mismatch)
    nothing = spread.limit(0).select("seq", F.lit("+").alias("strand"), F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("start"))
    candidates = reduce(DataFrame.unionByName, found, nothing)
    start, size = F.col("start"), F.col("size")
    inside = candidates.filter(start >= 0).join(pieces.hint("merge"), "piece").withColumn("len", F.length("seq")).filter(start + F.col("len") <= size)
    hits = inside.withColumn("qw", _words(_on_forward())).withColumn("nm", _mismatches()).filter(F.col("nm") <= max_mismatch)
    # found by several parts, or in pieces that overlap
    return stage(hits.withColumn("pos", F.col("off") + start).select("seq", "strand", "chrom", "pos", "len", "nm").distinct(), "text_hits")


def _near(max_mismatch: int) -> Column:
    """Whether the words on both sides of a seed do not differ in too many bases; odd letters are not counted here."""
    right = F.bit_count(_differing(F.col("right"), F.col("q_right")).bitwiseAND(F.col("right_mask")))
    left = F.bit_count(_differing(F.col("left"), F.col("q_left")).bitwiseAND(F.col("left_mask")))
    return right + left <= max_mismatch


def _mismatches() -> Column:
    """Bases that differ between a text (qw, len) and the piece (w) from ``start`` on; an odd letter differs from everything."""
    def one(q: Column, i: Column) -> Column:
        at = F.col("start") + i * WORD
        cell, r = F.floor(at / WORD).cast("int"), at % WORD
        first, second = F.get("w", cell), F.get("w", cell + 1)
        zero = F.lit(0).cast("bigint")
        codes = _across(first["c"], F.coalesce(second["c"], zero), r)
        odd = _across(first["x"], F.coalesce(second["x"], zero), r)
        bad = _differing(q["c"], codes).bitwiseOR(q["x"]).bitwiseOR(odd)
        inside = _right(F.lit(_ALL // 3), 2 * (WORD - F.least(F.col("len") - i * WORD, F.lit(WORD))))
        return F.bit_count(_right(bad, 2 * (WORD - F.least(F.col("len") - i * WORD, F.lit(WORD)))).bitwiseAND(inside)).cast("int")

    return F.aggregate(F.transform("qw", one), F.lit(0), lambda n, x: n + x)


def place_reads(reads: DataFrame, sequences: DataFrame, max_mismatch: int = 2) -> DataFrame:
    """All hits (sample, name, mate, chrom, pos, strand, len, nm); a read without any gives no row."""
    hits = text_hits(reads, sequences, max_mismatch)
    return reads.select("sample", "name", "mate", F.upper("seq").alias("seq")).join(hits, "seq").drop("seq")


def _choose(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the fewest mismatches the first hit, with ``x0``, the number of equally good ones; partial aggregates."""
    by_nm = hits.groupBy(*keys, "nm").agg(F.count("*").alias("x0"), F.min(F.struct("chrom", "pos", "strand", "len")).alias("hit"))
    best = by_nm.groupBy(*keys).agg(F.min(F.struct("nm", "x0", "hit")).alias("b"))
    return best.select(*keys, "b.hit.*", "b.nm", "b.x0")


def best_hits(hits: DataFrame) -> DataFrame:
    """One hit per read, of the fewest mismatches; ``x0`` counts the equally good ones.

    Ties go to the first by (chrom, pos, strand).
    """
    return _choose(hits, ["sample", "name", "mate"])


def best_placements(reads: DataFrame, sequences: DataFrame, max_mismatch: int = 2) -> DataFrame:
    """Every read with its best hit; chrom, pos, strand, len, nm and x0 are null for a read without one.

    The best hit is chosen per distinct text; hits of single reads are never formed.
    """
    of_text = _choose(text_hits(reads, sequences, max_mismatch), ["seq"])
    return reads.select("sample", "name", "mate", F.upper("seq").alias("seq")).join(of_text, "seq", "left").drop("seq")


def single_alignments(best: DataFrame) -> DataFrame:
    """Alignment rows of unpaired reads from their best hits; a read without one is kept with flag 0x4."""
    placed = F.col("pos").isNotNull()
    flag = F.when(~placed, UNMAPPED).when(F.col("strand") == "-", REVERSE).otherwise(0)
    return best.select(
        "sample", F.col("name").alias("qname"), F.lit(1).alias("mate"), flag.alias("flag"), "chrom",
        F.col("pos").alias("s"), (F.col("pos") + F.col("len")).alias("e"), "strand",
        F.lit(0).cast("bigint").alias("tlen"), "nm", F.col("x0").cast("int").alias("x0"))


def join_mates(hits1: DataFrame, hits2: DataFrame, smallest: int = 0, largest: int = 500,
               templates: DataFrame | None = None) -> DataFrame:
    """Alignment rows of both mates with flags and insert size.

    A proper pair lies on one chromosome, on opposite strands, the forward mate first,
    its outer ends within the range given. Of several the one with the fewest
    mismatches is taken, then the first. A read in no proper pair keeps its best hit;
    ``x0`` is always the number of its best hits, also where the pair lies elsewhere. With
    ``templates`` (sample, name) those without any hit are kept, unmapped on both sides.
    Candidates meet in a bin of the position, not in all positions of a name.
    """
    name = ["sample", "name"]

    def side(h: DataFrame, n: int) -> DataFrame:
        return h.select(*name, "chrom", F.col("pos").alias(f"s{n}"), (F.col("pos") + F.col("len")).alias(f"e{n}"),
                        F.col("strand").alias(f"st{n}"), F.col("nm").alias(f"nm{n}"))

    width = max(largest, 1)
    a = side(hits1, 1).select("*", F.explode(F.array(*[idiv("s1", width) + d for d in (-1, 0, 1)])).alias("bin"))
    b = side(hits2, 2).withColumn("bin", idiv("s2", width))
    size = F.greatest("e1", "e2") - F.least("s1", "s2")
    facing = ((F.col("st1") == "+") & (F.col("st2") == "-") & (F.col("s1") <= F.col("s2")) & (F.col("e1") <= F.col("e2"))) | (
        (F.col("st1") == "-") & (F.col("st2") == "+") & (F.col("s2") <= F.col("s1")) & (F.col("e2") <= F.col("e1"))
    )
    pair = F.struct((F.col("nm1") + F.col("nm2")).alias("nm"), "chrom", "s1", "s2", "e1", "e2", "st1", "st2", "nm1", "nm2")
    proper = (
        a.join(b, [*name, "chrom", "bin"]).filter(facing & size.between(smallest, largest))
        .groupBy(*name).agg(F.min(pair).alias("p"))
    )

    def best(h: DataFrame, n: int) -> DataFrame:
        return best_hits(h).select(*name, F.struct(
            "chrom", F.col("pos").alias("s"), (F.col("pos") + F.col("len")).alias("e"), "strand", "nm", "x0").alias(f"h{n}"))

    both = best(hits1, 1).join(best(hits2, 2), name, "full")
    if templates is not None:
        both = templates.select(*name).distinct().join(both, name, "left")
    return _mate_rows(both.join(proper, name, "left"))


def _mate_rows(both: DataFrame) -> DataFrame:
    """Alignment rows of both mates from (sample, name, h1, h2, p): the best hit of each and the best proper pair."""
    p = F.col("p")

    def mate(n: int, other: int, bit: int) -> Column:
        own, far = F.col(f"h{n}"), F.col(f"h{other}")
        strand = F.when(p.isNotNull(), p[f"st{n}"]).otherwise(own["strand"])
        far_strand = F.when(p.isNotNull(), p[f"st{other}"]).otherwise(far["strand"])
        flag = (
            F.lit(PAIRED | bit)
            + F.when(p.isNotNull(), PROPER).otherwise(0)
            + F.when(own.isNull(), UNMAPPED).otherwise(0)
            + F.when(far.isNull(), MATE_UNMAPPED).otherwise(0)
            + F.when(strand == "-", REVERSE).otherwise(0)
            + F.when(far_strand == "-", MATE_REVERSE).otherwise(0)
        )
        length = F.greatest(p["e1"], p["e2"]) - F.least(p["s1"], p["s2"])
        return F.struct(
            F.lit(n).alias("mate"), flag.alias("flag"),
            F.coalesce(p["chrom"], own["chrom"]).alias("chrom"),
            F.coalesce(p[f"s{n}"], own["s"]).alias("s"), F.coalesce(p[f"e{n}"], own["e"]).alias("e"),
            strand.alias("strand"),
            F.coalesce(F.when(strand == "-", -length).otherwise(length), F.lit(0).cast("bigint")).alias("tlen"),
            F.coalesce(p[f"nm{n}"], own["nm"]).alias("nm"), own["x0"].cast("int").alias("x0"),
        )

    return both.select(
        "sample", F.col("name").alias("qname"), F.explode(F.array(mate(1, 2, MATE_1), mate(2, 1, MATE_2))).alias("m")
    ).select("sample", "qname", "m.*")


def best_text_pairs(pairs: DataFrame, hits: DataFrame, smallest: int = 0, largest: int = 500) -> DataFrame:
    """The best proper pair ``p`` of each pair of texts (seq1, seq2) that has one, from the hits of distinct texts.

    For a hit of the first text and a number of mismatches, only the nearest place of the
    second one in the range can be the best; it is found by merging both along the
    chromosome. The text with fewer hits decides which stretches are looked at, so that one
    with very many places costs what lies near its partner's. A merge holds the places of a
    pair within two ranges' width, never combinations of them.
    """
    width = max(largest, 1) + 1
    count = hits.groupBy("seq").agg(F.count("*").alias("n"), F.any_value("len").alias("len"))
    known = pairs
    for n in (1, 2):  # a text without a hit is in no pair
        known = known.join(count.select(F.col("seq").alias(f"seq{n}"), F.col("n").alias(f"n{n}"), F.col("len").alias(f"len{n}")), f"seq{n}")
    rare = F.when(F.col("n1") <= F.col("n2"), 1).otherwise(2)
    known = known.withColumn("rare", rare).drop("n1", "n2")
    place = hits.select("seq", "strand", "chrom", "pos", "nm", idiv("pos", width).alias("bin"))
    pair = ["seq1", "seq2"]
    scarce = known.withColumn("seq", F.when(F.col("rare") == 1, F.col("seq1")).otherwise(F.col("seq2"))).join(place, "seq")
    near = (
        scarce.select(*pair, "rare", "len1", "len2", "chrom", F.explode(F.array(*[F.col("bin") + d for d in (-2, -1, 0, 1, 2)])).alias("bin"))
        .distinct().withColumn("seq", F.when(F.col("rare") == 1, F.col("seq2")).otherwise(F.col("seq1")))
    )
    other = near.join(place, ["seq", "chrom", "bin"])
    columns = [*pair, "len1", "len2", "chrom", "pos", "strand", "nm"]
    each = scarce.withColumn("mate", F.col("rare")).select(*columns, "mate").unionByName(
        other.withColumn("mate", 3 - F.col("rare")).select(*columns, "mate"))
    # the first mate forward: the second begins from s1 + from to s1 + to; the other way round likewise
    len1, len2, forward = F.col("len1"), F.col("len2"), F.col("strand") == "+"
    each = each.withColumns({
        "first": F.when(F.col("mate") == 1, forward).otherwise(~forward),  # whether the first mate is the forward one
        "from": F.when(forward, F.greatest(F.lit(0), len1 - len2, F.lit(smallest) - len2)).otherwise(len1 - largest),
        "to": F.when(forward, largest - len2).otherwise(F.least(F.lit(0), len1 - len2, len1 - smallest))})
    asks = each.filter("mate = 1").withColumns({"x": F.col("pos") + F.col("from"), "limit": F.col("pos") + F.col("to")}).withColumn(
        "bin", idiv("x", width))
    gives = each.filter("mate = 2").withColumns({"x": F.col("pos"), "limit": F.lit(None).cast("bigint")}).select(
        "*", F.explode(F.array(idiv("x", width), idiv("x", width) - 1)).alias("bin"))
    ahead = Window.partitionBy(*pair, "chrom", "first", "bin").orderBy(F.desc("x"), F.desc("mate"))
    classes = hits.agg(F.max("nm")).first()[0] or 0  # the number of mismatches allowed, at most
    following = [F.last(F.when((F.col("mate") == 2) & (F.col("nm") == k), F.col("pos")), ignorenulls=True).over(ahead).alias(f"p{k}")
                 for k in range(classes + 1)]
    met = asks.unionByName(gives).select("*", *following).filter("mate = 1")
    options = F.filter(
        F.array(*(F.struct(F.col(f"p{k}").alias("s2"), F.lit(k).alias("nm2")) for k in range(classes + 1))),
        lambda o: o["s2"].isNotNull() & (o["s2"] <= F.col("limit")))
    chosen = met.select(*pair, "chrom", "len1", "len2", F.col("pos").alias("s1"), F.col("nm").alias("nm1"), "strand", F.inline(options))
    best = F.struct(
        (F.col("nm1") + F.col("nm2")).alias("nm"), "chrom", "s1", "s2", (F.col("s1") + len1).alias("e1"), (F.col("s2") + len2).alias("e2"),
        F.col("strand").alias("st1"), F.when(forward, "-").otherwise("+").alias("st2"), "nm1", "nm2")
    return chosen.groupBy(*pair).agg(F.min(best).alias("p"))


def pair_placements(reads: DataFrame, sequences: DataFrame, max_mismatch: int = 2, smallest: int = 0, largest: int = 500) -> DataFrame:
    """Alignment rows of both mates of every template of ``reads``, as ``join_mates`` gives them.

    Hits, best hits and proper pairs belong to texts and pairs of texts: a read is one row
    whatever number of places its text has. Templates without any hit are kept.
    """
    name = ["sample", "name"]
    hits = text_hits(reads, sequences, max_mismatch)
    side = [reads.filter(F.col("mate") == n).groupBy(*name).agg(F.min(F.upper("seq")).alias(f"seq{n}")) for n in (1, 2)]
    templates = stage(side[0].join(side[1], name, "full"), "templates")
    proper = best_text_pairs(templates.select("seq1", "seq2").dropna().distinct(), hits, smallest, largest)
    best = _choose(hits, ["seq"])
    both = templates
    for n in (1, 2):
        one = best.select(F.col("seq").alias(f"seq{n}"), F.struct(
            "chrom", F.col("pos").alias("s"), (F.col("pos") + F.col("len")).alias("e"), "strand", "nm", "x0").alias(f"h{n}"))
        both = both.join(one, f"seq{n}", "left")
    return _mate_rows(both.join(proper, ["seq1", "seq2"], "left"))

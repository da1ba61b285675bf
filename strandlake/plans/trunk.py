"""The analyses from alignments to tracks, peaks and metrics.

What several results read (marked and pruned alignments, scored pileups, tags) is
written once; a study of many samples is one set of jobs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.arith import PAIRED, has_any
from ..operators import alignments as al, coverage as cov, manifest as mf, motifs as mo, peaks as pk, qc, tags as tg
from ..operators.intervals import exclude_overlaps, exclude_peaks_and_summits, keep_by_id, peaks_to_bed, place_keys
from ..session import stage, stage_by

TRACK = ["sample", "chrom"]


def with_genomes(alignments: DataFrame, samplesheet: DataFrame) -> DataFrame:
    """Adds each sample's genome; pruning, exclusion and point features then go by genome and chromosome.

    The sheet's samples are written first, so that Spark knows how few they are and does not
    shuffle the alignments by sample, which would leave a task per sample.
    """
    return alignments.join(stage(samplesheet.select("sample", "genome").distinct(), "genomes"), "sample")


def prune_atac(alignments: DataFrame, genome: str | None = None) -> DataFrame:
    """The chromosome filter goes first, where it reaches the scan: copies share their chromosome.

    Without ``genome`` the alignments name it themselves (``with_genomes``).
    """
    marked = al.mark_duplicates(al.keep_chromosomes(alignments, genome))
    return al.filter_flags(marked, *al.PRUNE_ATAC)


def prune_chip_paired(alignments: DataFrame, genome: str | None = None, threshold: int = 2, mode: str = "both") -> DataFrame:
    marked = al.mark_duplicates(al.keep_chromosomes(alignments, genome))
    return al.x0_pair_filter(al.filter_flags(marked, *al.PRUNE_CHIP_PAIRED), threshold, mode)


def prune_chip_single(alignments: DataFrame, genome: str | None = None) -> DataFrame:
    marked = al.mark_duplicates(al.keep_chromosomes(alignments, genome))
    return al.filter_flags(marked, *al.PRUNE_CHIP_SINGLE)


def prune_chip(alignments: DataFrame, genome: str | None = None, threshold: int = 2, mode: str = "both") -> DataFrame:
    """Pairs and single reads side by side: each read is pruned by the rules of its own layout (flag 0x1)."""
    marked = al.mark_duplicates(al.keep_chromosomes(alignments, genome))
    return _prune_by_layout(marked, threshold, mode)


def _prune_by_layout(marked: DataFrame, threshold: int = 2, mode: str = "both") -> DataFrame:
    paired = has_any("flag", PAIRED)
    pairs = al.x0_pair_filter(al.filter_flags(marked.filter(paired), *al.PRUNE_CHIP_PAIRED), threshold, mode)
    return pairs.select(marked.columns).unionByName(al.filter_flags(marked.filter(~paired), *al.PRUNE_CHIP_SINGLE))


def whole_fragments(pruned: DataFrame, length: int | None = None) -> DataFrame:
    """Fragments of pairs; ``length`` is that of unpaired reads, which may stand beside pairs."""
    genome = [c for c in ("genome",) if c in pruned.columns]
    return cov.fragments(cov.extend_reads(pruned, unpaired=length)).select(*TRACK, "s", "e", *genome)


def track(pruned: DataFrame, excluded: DataFrame | None = None, width: int = 25, length: int | None = None) -> DataFrame:
    """CPM of whole fragments per bin, outside the excluded regions.

    The fragments are read twice, for the bins and for the totals, so they are staged.
    """
    used = whole_fragments(pruned, length)
    if excluded is not None:
        used = exclude_overlaps(used, excluded, place_keys(used, excluded))
    return cov.coverage_excluding(stage(used, "fragments"), width=width)


def atac_peaks(fragments: DataFrame, genome_size: float | DataFrame, paramsets: Mapping[str, Mapping[str, float]],
               excluded: DataFrame) -> dict[str, DataFrame]:
    """Peaks under every parameter set: all of them, and peaks and summits outside the excluded regions.

    The pileup is scored once and cut once per set. ``genome_size`` may be a table (sample, genome_size).
    """
    scored = stage(pk.scored_pileup(fragments, genome_size), "scored")
    found = stage(pk.summits(pk.sweep(scored, paramsets), fragments), "peaks")
    table = stage(pk.narrowpeak(found, scored), "narrowpeak")
    if "genome" in fragments.columns:
        table = table.join(fragments.select("sample", "genome").distinct(), "sample")
    tops = table.select(
        "paramset", *TRACK, (F.col("s") + F.col("offset")).alias("s"),
        (F.col("s") + F.col("offset") + 1).alias("e"), "name", *[c for c in ("genome",) if c in table.columns],
    )
    kept, kept_tops = exclude_peaks_and_summits(table, tops, excluded)
    return {"all": table, "peaks": kept, "summits": kept_tops}


def atac_study(alignments: DataFrame, genome: str | None, genome_size: float | DataFrame | None, excluded: DataFrame, tss: DataFrame,
               paramsets: Mapping[str, Mapping[str, float]], clean_track: bool = False) -> dict[str, DataFrame]:
    """Track, peaks and metrics. Metrics see marked but unpruned alignments and unfiltered peaks of each parameter set.

    Without ``genome`` the samples' own are used: the alignments carry the column, and so
    may the tables of excluded regions and points. ``genome_size`` None: the effective size of
    each sample's genome. ``clean_track`` takes fragments in excluded regions out of the track.
    """
    if genome_size is None:
        named = alignments if genome is None else alignments.withColumn("genome", F.lit(genome))
        genome_size = stage(pk.effective_sizes(named.select("sample", "genome").distinct()), "sizes")
    marked = stage(al.mark_duplicates(alignments), "marked")
    pruned = al.filter_flags(al.keep_chromosomes(marked, genome), *al.PRUNE_ATAC)
    fragments = stage(whole_fragments(pruned), "fragments")
    peaks = atac_peaks(fragments, genome_size, paramsets, excluded)
    seen = qc.exclude_regions(marked, excluded)
    regions = peaks["all"].select("paramset", *TRACK, "s", "e")
    enrichment = qc.tss_enrichment(qc.exclude_regions(fragments, excluded), tss)
    metrics = (
        qc.duplicate_split(seen, regions, list(paramsets))
        .join(qc.read_counts(marked), "sample", "right")
        .join(qc.tss_score(enrichment), "sample", "left")
    )
    return {
        "duplicates": al.duplicate_metrics(marked),
        "track": cov.coverage_excluding(fragments, excluded if clean_track else None),
        **peaks,
        "lengths": qc.fragment_lengths(marked),
        "metrics": metrics,
        "rollup": qc.metrics_rollup(qc.long_metrics(metrics, ("paramset", "sample"))),
    }


def tag_peaks(tags: DataFrame, samplesheet: DataFrame, paramsets: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Peaks of every sample with a control under every parameter set.

    A set holds ``style`` (``factor``: fixed width, ``histone``: variable width), ``fold``
    and the settings of that finder. Paired and single reads mix freely: a tag is a 5' end.
    With ``fdr`` and ``genome_size`` instead of a threshold, each sample has the least one at
    which expected and observed peaks of that width stand in the rate asked for; a
    sample that never reaches the rate has no peaks.
    """
    finders = {"factor": tg.find_peaks_factor, "histone": tg.find_peaks_region}
    pairs = mf.pair_controls(samplesheet).select("sample", "control")
    treated = tags.join(pairs.select("sample").distinct(), "sample", "left_semi")
    against = mf.label_controls(tags, pairs)
    found = None
    for name, settings in paramsets.items():
        rest = {k: v for k, v in settings.items() if k not in ("style", "fold", "fdr", "genome_size")}
        if "fdr" in settings:
            width = int(rest.get("width", 200))
            tops = tg.find_peaks_factor(treated, width, int(rest.get("min_dist", 2 * width)), 1, int(rest.get("shift", 0)))
            cutoffs = tg.fdr_cutoff(tops, treated, float(settings["genome_size"]), width, float(settings["fdr"]))
            rest["threshold"] = stage(cutoffs, "cutoffs")
        peaks = finders[str(settings.get("style", "factor"))](treated, **rest)
        kept = tg.control_filter(peaks, treated, against, float(settings.get("fold", 4.0)))
        part = kept.select(F.lit(name).alias("paramset"), *TRACK, "s", "e", "tags")
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no parameter sets given")
    return found


def outside(rows: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a peak report whose BED line survives the exclusion, chosen by id."""
    named = rows.withColumn("id", F.concat_ws("|", *keys, "id"))
    bed = peaks_to_bed(named)
    if "genome" in named.columns:
        bed = bed.join(named.select(F.col("id").alias("name"), "genome").distinct(), "name")
    kept = keep_by_id(named, exclude_overlaps(bed, excluded, place_keys(bed, excluded)))
    return kept.withColumn("id", F.substring_index("id", "|", -1)).select(rows.columns)


def chip_peaks(pruned: DataFrame, samplesheet: DataFrame, excluded: DataFrame, style: str = "factor",
               fold: float = 4.0, **settings: int) -> DataFrame:
    """Peaks of every sample with a control, outside the excluded regions, under one setting."""
    tags = stage(tg.tag_directory(pruned), "tags")
    peaks = tag_peaks(tags, samplesheet, {"": {"style": style, "fold": fold, **settings}})
    return outside(stage(tg.peak_rows(peaks), "hpeaks"), excluded, ["sample"])


def chip_study(alignments: DataFrame, samplesheet: DataFrame, excluded: DataFrame,
               paramsets: Mapping[str, Mapping[str, object]], sequences: DataFrame | None = None, chunk: int = 1 << 16,
               length: int | None = None, max_dist: int = 1000, word: int = 8) -> dict[str, DataFrame]:
    """Tracks, duplicate metrics, peaks, report lines and motifs of a study, each sample on its own genome.

    Paired and single samples mix: reads are pruned by their own layout, and single ones
    extended to ``length`` in the tracks.
    Tags are centred by the fragment length that their autocorrelation shows. ``report`` holds
    the header and the rows outside the excluded regions, as written by
    ``write_peak_report``; its fourth header line counts those rows. With ``sequences`` (genome
    chunks; with the genome's name, each sample's own) words are compared between the kept peaks
    of each sample and parameter set and the stretches beside them.
    """
    own = with_genomes(alignments, samplesheet)
    # marking leaves the records dealt out by name, and so the pair filter finds them
    marked = stage_by(al.mark_duplicates(own), "marked", al.MATE_KEY, spread=False)
    kept = al.keep_chromosomes(marked)
    pruned = stage(_prune_by_layout(kept), "pruned")
    raw = stage(tg.tag_directory(pruned), "raw-tags")
    lengths = stage(tg.fragment_length(tg.tag_autocorrelation(raw, max_dist)), "lengths")
    tags = stage(tg.centre_tags(raw, lengths), "tags")
    peaks = stage(tag_peaks(tags, samplesheet, paramsets), "peaks")
    genomes = samplesheet.select("sample", "genome").distinct()
    rows = stage(tg.peak_rows(peaks, ["paramset"]).join(genomes, "sample"), "hpeaks")
    clean = stage(outside(rows, excluded, ["paramset", "sample"]), "clean-hpeaks")
    out = {
        "duplicates": al.duplicate_metrics(marked),
        "track": track(pruned, excluded, length=length),
        "lengths": lengths,
        "all": rows,
        "peaks": clean,
        "header": tg.filtered_header(tg.report_header(peaks, tags, ["paramset"]), clean, ["paramset"]),
    }
    if sequences is not None:
        spots = clean.select("paramset", "sample", "id", "genome", "chrom",
                             (F.col("start") - 1).alias("s"), F.col("end").alias("e"))
        width = F.col("e") - F.col("s")
        beside = spots.withColumn("s", F.col("e") + width).withColumn("e", F.col("s") + width)
        of = ["paramset", "sample"]
        out["motifs"] = mo.motif_enrichment(
            mo.peak_sequences(spots, sequences, chunk, [*of, "id"]), mo.peak_sequences(beside, sequences, chunk, [*of, "id"]), word, of)
    return out

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from strandlake.plans import load_queries
from strandlake.session import get_session

HEADLINE = [
    "mark_duplicates", "duplicate_metrics", "x0_pair_filter", "prune_atac_alignments", "prune_chip_paired_alignments",
    "clean_pair_track", "overlap_join", "exclude_overlaps", "merge_fragments", "overlap_counts", "bin_coverage",
    "normalise_cpm", "depth", "window_counts_paired", "zoom", "scored_pileup", "call_peaks", "sweep_paramsets",
    "narrowpeak", "tag_directory", "tag_autocorrelation", "find_peaks_factor", "find_peaks_region",
    "chip_peaks_against_control", "read_counts", "peak_fractions", "duplicate_split", "tss_enrichment",
    "motif_enrichment", "place_reads", "join_mates", "fastq_round_trip", "sam_round_trip",
    "clean_single_track", "clean_track_two_genomes", "tag_peaks_paramsets", "chip_report", "best_hits",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    queries = load_queries()[0]
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in queries]
    spark.range(1000).selectExpr("sum(id)").collect()  # the session itself is not measured
    times = {}
    for name in names:
        t = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()

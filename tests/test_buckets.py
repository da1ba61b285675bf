"""Records in buckets by name go through marking and the pair filter without another shuffle."""

import re

from strandlake import session
from strandlake.operators import alignments as al
from strandlake.plans import trunk, views as v


def exchanged(df):
    """For each exchange by name in the plan that runs first, the columns that it moves."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    lines = plan.split("\n")
    found = []
    for k, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(sample#\d+, qname#\d+, \d+\), ENSURE", line):
            found.append(lines[k + 1])
    return found


def test_no_exchange_of_records(spark, sf_dir):
    records = session.stage_by(v.alignments(spark, sf_dir), "records", al.MATE_KEY)
    got = trunk.prune_chip_paired(records, "mm10")
    moved = exchanged(got)
    # only the winners of each position come back by name, two aggregates in one exchange
    assert len(moved) == 1 and "Aggregate" in moved[0] and "qual" not in moved[0]
    plain = trunk.prune_chip_paired(v.alignments(spark, sf_dir), "mm10")
    assert len(exchanged(plain)) > 1
    key = ["sample", "qname", "mate", "chrom", "s", "flag"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))


def test_marked_records_stay_dealt_out_by_name(spark, sf_dir):
    marked = session.stage_by(al.mark_duplicates(v.alignments(spark, sf_dir)), "marked", al.MATE_KEY, spread=False)
    assert exchanged(al.x0_pair_filter(marked)) == []
    assert marked.count() == v.alignments(spark, sf_dir).count()


def test_staged_tables_are_dropped(spark):
    kept = list(session._staged), list(session._tables)
    session._staged[:], session._tables[:] = [], []
    df = session.stage_by(spark.range(5), "few", ["id"])
    name = session._tables[0]
    assert df.count() == 5 and spark.catalog.tableExists(name)
    assert session.drop_staged(spark) == 1 and not spark.catalog.tableExists(name)
    session._staged[:], session._tables[:] = kept

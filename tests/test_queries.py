"""Every registered query beside its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import compare
from strandlake.plans import load_queries

QUERIES, SQL = load_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck, sf_dir):
    line, ok, _ = compare(spark, duck, sf_dir, name, QUERIES[name], SQL[name])
    assert ok, line


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries())


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["sample", "chrom", "bin", "n", "cpm"]
    assert df.count() > 0

"""References by genome: a study reads its own only. Correlations by transform beside plain sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.operators import tags as tg
from strandlake.plans import trunk, views as v
from strandlake.sources.catalog import read_catalog, write_catalog


def test_a_study_reads_its_own_references(spark, sf_dir, tmp_path):
    path = str(tmp_path / "catalog")
    genomes = F.explode(F.array(*map(F.lit, ["hg19", "mm10", "rn5"])))
    points = v.tss(spark, sf_dir).withColumn("genome", genomes)
    regions = v.excluded(spark, sf_dir).withColumn("genome", genomes)
    write_catalog({"points": points, "excluded": regions}, path)
    sheet = spark.createDataFrame([("S1", "hg19"), ("S2", "mm10"), ("S3", None)], "sample string, genome string")
    own = read_catalog(spark, path, "points", sheet)
    assert {r["genome"] for r in own.select("genome").distinct().collect()} == {"hg19", "mm10"}
    assert own.count() == 2 * v.tss(spark, sf_dir).count()
    own.collect()
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    study = trunk.with_genomes(v.alignments(spark, sf_dir), sheet.filter("genome is not null"))
    out = trunk.atac_study(study, None, None, read_catalog(spark, path, "excluded", sheet), own, {"p": {"q": 0.05}})
    assert {r["sample"] for r in out["metrics"].collect()} == {"S1", "S2"}
    with pytest.raises(ValueError):
        write_catalog({"points": v.tss(spark, sf_dir)}, str(tmp_path / "other"))


@pytest.mark.parametrize("top, filled", [(3, 0.5), (3, 0.001), (1 << 22, 0.5), (1 << 27, 0.01)])
def test_shifted_products_are_exact(top, filled):
    rng = np.random.default_rng(top)
    n, reach = 20_000, 700
    b = np.where(rng.random(n + reach) < filled, rng.integers(0, top, n + reach), 0)
    c = np.where(rng.random(n + reach) < filled, rng.integers(0, top, n + reach), 0)
    got = tg.shifted_products([(b[:n], b), (c[:n], c)], reach)
    for d in (0, 1, 5, 333, reach):
        assert got[d] == sum(int(x) * int(y) for x, y in zip(b[:n], b[d : n + d])) + sum(int(x) * int(y) for x, y in zip(c[:n], c[d : n + d]))


def test_lengths_of_transforms():
    for n in (1, 7, 131_073, 132_072, 99_999):
        size = tg._smooth(n)
        assert n <= size < 2 * n + 2
        for p in (2, 3, 5):
            while size % p == 0:
                size //= p
        assert size == 1

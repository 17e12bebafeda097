"""One key holding a third of all rows: results stay whole and work is split."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtally.operators import atlas, coloc, report, structures
from voxtally.operators.components import components
from voxtally.schema import VolumeMeta

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def crowded(spark, n=60_000):
    """A third of all points on voxel (4, 4, 4) of a 20-voxel cube."""
    spread = [F.pmod(F.xxhash64("id", F.lit(a)), F.lit(20)).cast("int") for a in range(3)]
    hot = F.col("id") % 3 == 0
    axes = [F.when(hot, 4).otherwise(s).alias(a) for a, s in zip("zyx", spread)]
    return spark.range(0, n, 1, 8).select(F.col("id").alias("cell_id"), *axes)


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_splits_a_hot_voxel(tight):
    cells = crowded(tight)
    labels = tight.range(1000).selectExpr(
        "cast(id div 100 as int) z", "cast(id div 10 % 10 as int) y", "cast(id % 10 as int) x", "id + 1 as region_id",
        "id % 3 as hemisphere_id",
    )
    found = atlas.lookup_labels(cells, labels, (20, 20, 20), (10, 10, 10))
    wrong = found.filter("found_region <> (z div 2) * 100 + (y div 2) * 10 + (x div 2) + 1")
    assert found.count() == 60_000 and wrong.count() == 0
    rows = found.collect()
    assert len(rows) == 60_000
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_mask_test_splits_a_hot_voxel(tight):
    cells = crowded(tight)
    mask = tight.range(4000).selectExpr("cast(id div 400 as int) z", "cast(id div 20 % 20 as int) y", "cast(id % 20 as int) x", "1 as value")
    found = coloc.points_in_mask(cells, mask)
    rows = found.collect()
    assert len(rows) == 60_000 and all(r.in_mask == (r.z < 10) for r in rows)
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_hot_region_rolls_up(tight):
    tree = tight.createDataFrame([("R", 1, "Root", "/1/"), ("A", 2, "A", "/1/2/")], "acronym string, id bigint, name string, structure_id_path string")
    cells = crowded(tight).selectExpr("'m' as biomarker", "true as passed_filter", "2 as region_id", "cast(1 as tinyint) as hemisphere_id")
    tallies = report.cell_tallies(cells, "m")
    rolled = structures.rollup_tiers(tallies, tree, ["total_cells", "left_cells"])
    assert {(r.acronym, r.total_cells, r.left_cells) for r in rolled.collect()} == {("R", 60_000, 60_000), ("A", 60_000, 60_000)}


def test_repeated_voxels_collapse_before_the_shuffle(tight):
    voxels = crowded(tight).select("z", "y", "x").unionByName(crowded(tight).select("z", "y", "x"))
    mask = np.zeros((20, 20, 20), bool)
    for r in voxels.distinct().collect():
        mask[r.z, r.y, r.x] = True
    whole = components(voxels, VolumeMeta(mask.shape, "uint8"), 26)
    assert whole.agg(F.sum("n")).first()[0] == mask.sum()

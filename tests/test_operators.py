"""Table operators on small hand-computed cases."""

import math

import pytest
from pyspark.sql import functions as F

from voxtally.functions import coords
from voxtally.operators import atlas, coloc, filtering, report, structures, volume
from voxtally.schema import CELL_SCHEMA

TREE = [
    ("ROOT", 1, "Root", "/1/", None),
    ("A", 2, "Region A", "/1/2/", 1),
    ("A1", 3, "Region A sub1", "/1/2/3/", 2),
    ("B", 4, "Region B", "/1/4/", 1),
]


@pytest.fixture(scope="module")
def tree(spark):
    ddl = "acronym string, id bigint, name string, structure_id_path string, parent_structure_id bigint"
    return spark.createDataFrame(TREE, ddl)


def cell(k, z, y, x, n=30, mark="cFos", region=None, side=0, passed=True):
    return (k, z, y, x, n, float(n), mark, region, side, "B1", "r1", passed)


def cells_of(spark, *rows):
    return spark.createDataFrame(list(rows), CELL_SCHEMA)


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_filter_is_inclusive_and_keeps_other_rows(spark):
    cells = cells_of(
        spark, cell(1, 0, 0, 0, 9, passed=True), cell(2, 0, 0, 0, 10, passed=False), cell(3, 0, 0, 0, 20, passed=False),
        cell(4, 0, 0, 0, 21), cell(5, 0, 0, 0, 5, "TH", passed=True),
    )
    out = filtering.apply_volume_filter(cells, "cFos", 10, 20)
    assert by(out, "cell_id", "passed_filter") == {1: False, 2: True, 3: True, 4: False, 5: True}
    assert filtering.filter_summary(out, "cFos").first().asDict() == {"total": 4, "passed": 2}


def test_rollup(spark, tree):
    tallies = spark.createDataFrame([(3, 5), (4, 7), (99, 1000)], "id int, n bigint")
    rolled = structures.rollup_tiers(tallies, tree, ["n"])
    assert {(r.tier, r.acronym): r.n for r in rolled.collect()} == {(1, "ROOT"): 12, (2, "A"): 5, (2, "B"): 7, (3, "A1"): 5}


def test_subtree(spark, tree):
    region = structures.find_region(tree, "A")
    assert (region.id, region.name) == (2, "Region A")
    assert {r.id for r in structures.subtree_ids(tree, region).collect()} == {2, 3}
    with pytest.raises(ValueError):
        structures.find_region(tree, "nope")


def test_geometry_with_labels_and_midline(spark, tree):
    rows = [(z, y, x, 3 if y < 2 else 4, 1 if x < 1 else 2) for z in range(2) for y in range(4) for x in range(4)]
    labels = spark.createDataFrame(rows, "z int, y int, x int, region_id bigint, hemisphere_id bigint")
    out = {r.acronym: r for r in report.geometry_report(labels, tree, (4.0, 2.0, 2.0)).collect()}
    assert [out[a].total_voxels for a in ("A1", "A", "ROOT")] == [16, 16, 32]
    assert out["A1"].total_volume_mm3 == pytest.approx(256e-9)
    assert (out["A1"].left_voxels, out["A1"].right_voxels) == (4, 12)
    half = by(report.geometry_report(labels, tree, (4.0, 2.0, 2.0), midline=2), "acronym", "left_voxels")
    assert half == {"ROOT": 16, "A": 8, "A1": 8, "B": 8}


def test_tiered_report(spark, tree):
    rows = [(z, y, x, 3 if y < 2 else 4, 1 if x < 2 else 2) for z in range(2) for y in range(4) for x in range(4)]
    labels = spark.createDataFrame(rows, "z int, y int, x int, region_id bigint, hemisphere_id bigint")
    geometry = report.geometry_report(labels, tree, (4.0, 2.0, 2.0))
    cells = cells_of(
        spark, *[cell(k, 0, 0, 0, region=3, side=1) for k in range(4)], cell(5, 0, 3, 3, region=4, side=2),
        cell(6, 0, 0, 0, region=3, side=1, passed=False), cell(7, 0, 0, 0, region=None), cell(8, 0, 0, 0, mark="TH", region=3),
    )
    full = report.tiered_cell_report(cells, tree, geometry, "cFos")
    out = {r.acronym: r for r in full.collect()}
    assert out["A1"].left_cells_per_mm3 == pytest.approx(4 / 128e-9)
    assert (out["A1"].Diff_Percent, out["A1"].Dominant_Side, out["A1"].Signif_Diff_gt30pct) == (100.0, "Left", True)
    assert (out["B"].Diff_Percent, out["B"].Dominant_Side) == (-100.0, "Right")
    assert (out["ROOT"].total_cells, out["ROOT"].Diff_Percent) == (5, 300.0)
    top = report.target_summary(full, ["REGION a"], ["RO"], cell_threshold=1).collect()
    assert [r.acronym for r in top] == ["ROOT", "A1", "A"] and top[0].Source_Tier == 1
    assert [r.acronym for r in report.target_summary(full, ["ignored"], ["B"], True).collect()] == ["B"]
    assert report.target_summary(full, [], []).count() == 0


@pytest.mark.parametrize(
    "left, right, diff, side, strong",
    [
        (2.0, 1.0, 100.0, "Left", True), (1.0, 2.0, -50.0, "Right", True), (0.0, 0.0, 0.0, "None", False),
        (3.0, 0.0, 100.0, "Left", True), (1.0, None, None, "None", False), (None, 0.0, 0.0, "None", False),
        (1.0, math.inf, None, "Right", False), (1.1, 1.0, 10.0, "Left", False),
    ],
)
def test_asymmetry_edges(spark, left, right, diff, side, strong):
    frame = spark.createDataFrame([(left, right)], "left_cells_per_mm3 double, right_cells_per_mm3 double")
    row = report.add_asymmetry(frame).first()
    assert (row.Diff_Percent, row.Dominant_Side, row.Signif_Diff_gt30pct) == (diff, side, strong)


def test_lookup_clamps_and_keeps_other_rows(spark):
    rows = [(z, y, x, 42 if x < 2 else 99, 1 if x < 2 else 2) for z in range(5) for y in range(5) for x in range(5)]
    labels = spark.createDataFrame(rows, "z int, y int, x int, region_id bigint, hemisphere_id bigint").filter("z <> 0")
    cells = cells_of(
        spark, cell(1, 9, 9, 9), cell(2, 50, 3, 2, passed=False), cell(3, 0, 0, 0), cell(4, 9, 9, 9, mark="TH", region=7, side=2)
    ).withColumn("colocalized_with_X", F.lit(True))
    out = atlas.assign_regions(cells, labels, (10, 10, 10), (5, 5, 5), "cFos")
    assert by(out, "cell_id", "region_id") == {1: 99, 2: 42, 3: 0, 4: 7}
    assert by(out, "cell_id", "hemisphere_id") == {1: 2, 2: 1, 3: 0, 4: 2}
    assert out.filter("colocalized_with_X").count() == 4
    sided = atlas.assign_regions(cells, labels, (10, 10, 10), (5, 5, 5), "cFos", cells_midline=True)
    assert by(sided, "cell_id", "hemisphere_id") == {1: 2, 2: 1, 3: 1, 4: 2}


def test_label_table_keeps_both_sides(spark):
    a = spark.createDataFrame([(0, 0, 0, 5), (0, 0, 1, 6)], "z int, y int, x int, value bigint")
    h = spark.createDataFrame([(0, 0, 1, 2), (0, 0, 2, 1)], "z int, y int, x int, value bigint")
    out = {r.x: (r.region_id, r.hemisphere_id) for r in atlas.label_table(a, h).collect()}
    assert out == {0: (5, 0), 1: (6, 2), 2: (0, 1)}


def test_colocalisation(spark, tree):
    mask = spark.createDataFrame([(z, y, x) for z in range(10) for y in range(10) for x in range(5)], "z int, y int, x int")
    cells = cells_of(
        spark, cell(1, 1, 1, 1, region=3), cell(2, 1, 1, 8, region=4), cell(3, 1, 1, 1, passed=False), cell(4, 1, 1, 1, mark="TH"),
        cell(5, -1, 0, 0, passed=False),
    )
    out = coloc.colocalize_pair(cells, "TH", "cFos", mask)
    assert by(out, "cell_id", "colocalized_with_TH") == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert coloc.coloc_summary(out, "TH", "cFos").first().asDict() == {"tested": 2, "colocalized": 1}
    assert coloc.coloc_summary(cells, "TH", "cFos").first().asDict() == {"tested": 0, "colocalized": 0}
    again = coloc.colocalize_pair(out, "GFAP", "cFos", mask)
    assert {"colocalized_with_TH", "colocalized_with_GFAP"} <= set(again.columns)
    stale = coloc.colocalize_pair(out.withColumn("passed_filter", F.lit(False)), "TH", "cFos", mask)
    assert stale.filter("colocalized_with_TH").count() == 0
    rates = by(coloc.tiered_coloc_report(out, tree, "TH", "cFos"), "acronym", "colocalization_rate")
    assert rates == {"ROOT": 0.5, "A": 1.0, "A1": 1.0, "B": 0.0}


def test_atlas_redraw_drops_what_lookup_clamps(spark):
    cells = cells_of(spark, cell(1, 15, 0, 0), cell(2, 4, 4, 4), cell(3, 4, 5, 4))
    drawn = volume.redraw_atlas(cells, "cFos", (10, 10, 10), (5, 5, 5))
    assert {(r.z, r.y, r.x, r.value) for r in drawn.collect()} == {(2, 2, 2, 255)}
    assert volume.redraw_native(cells, "cFos", (10, 10, 10)).count() == 2
    assert volume.outside_count(cells, (10, 10, 10)).first().asDict() == {"kept": 2, "dropped": 1}


def test_orders():
    assert coords.invert_order((2, 0, 1)) == (1, 2, 0)
    assert coords.is_self_inverse((1, 0, 2)) and not coords.is_self_inverse((2, 0, 1))
    with pytest.raises(ValueError):
        coords.check_order((0, 0, 1))


def test_system_rules_take_any_entry_and_no_missing_value(spark):
    from voxtally.functions.ontology import SystemRule

    rows = [("Motor area", "MO"), ("limbic part", None), (None, "MOp"), (None, None), ("thalamus", "TH"), ("x", "mo")]
    table = spark.createDataFrame(rows, "name string, acronym string")

    def held(rule):
        return [r.t for r in table.select(rule.holds(F.col("name"), F.col("acronym")).alias("t")).collect()]

    assert held(SystemRule.of(["MOTOR|limb"], ["MO", "T."], False)) == [True, True, True, False, True, False]
    assert held(SystemRule.of(["motor"], ["TH", "MO"], True)) == [True, False, False, False, True, False]
    assert held(SystemRule()) == [False] * 6

"""Registered queries over the operators; each runs on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtally.functions import coords, ontology
from voxtally.functions.measures import density
from voxtally.operators import atlas, coloc, components, filtering, report, structures, volume
from voxtally.plans import views
from voxtally.plans.views import BIOMARKERS, BOUNDS, VOXEL_SIZE_UM, Brain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAIRS = [("TH", "cFos"), ("TH", "GFAP"), ("GFAP", "cFos")]
# Functional system used by the tagging queries.
KEYWORDS = ["asia", "nation_1"]
ACRONYMS = ["N2", "C7"]
EXACT_ACRONYMS = ["R1", "N3", "C42"]
THRESHOLD = 5


def register(name: str):
    def add(build: Callable[[Brain], DataFrame]) -> Callable[[Brain], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(views.brain(spark, folder))
        return build

    return add


def _geometry(b: Brain) -> DataFrame:
    return report.geometry_report(views.labels(b), views.structures(b), VOXEL_SIZE_UM)


def _cell_report(b: Brain, biomarker: str = "TH") -> DataFrame:
    return report.tiered_cell_report(views.assigned_cells(b), views.structures(b), _geometry(b), biomarker)


def _colocalized(b: Brain) -> DataFrame:
    return coloc.colocalize_pair(views.assigned_cells(b), "TH", "cFos", views.mask(b))


# --- projections and filters -------------------------------------------------


@register("volume_filter_o21")
def _(b: Brain) -> DataFrame:
    cells = filtering.apply_volume_filter(views.cells(b), "cFos", *BOUNDS)
    return cells.select("cell_id", "z", "y", "x", "volume_voxels", "biomarker", "passed_filter")


@register("filter_summary_o54")
def _(b: Brain) -> DataFrame:
    return filtering.filter_summary(filtering.apply_volume_filter(views.cells(b), "cFos", *BOUNDS), "cFos")


@register("foreground_o22")
def _(b: Brain) -> DataFrame:
    voxels = views.annotation(b).withColumn("value", F.when(F.col("value") % 5 == 0, 0).otherwise(F.col("value")))
    return voxels.filter("value > 0").groupBy("z").agg(F.count(F.lit(1)).alias("foreground"))


@register("outside_drop_o23")
def _(b: Brain) -> DataFrame:
    shifted = views.cells(b).withColumns({"z": F.col("z") - 1, "x": F.col("x") + 2})
    return volume.outside_count(shifted, b.native)


@register("null_region_drop_o25")
def _(b: Brain) -> DataFrame:
    only_th = atlas.assign_regions(views.filtered_cells(b), views.labels(b), b.native, b.atlas, "TH")
    return only_th.filter("region_id is not null").groupBy("biomarker").agg(F.count(F.lit(1)).alias("cells"))


@register("system_tag_exact_o26")
def _(b: Brain) -> DataFrame:
    tag = ontology.SystemRule(whole=tuple(EXACT_ACRONYMS)).holds(F.col("name"), F.col("acronym"))
    return views.structures(b).select("id", "acronym", tag.alias("is_target"))


@register("system_tag_regex_o26")
def _(b: Brain) -> DataFrame:
    tag = ontology.SystemRule(tuple(KEYWORDS), tuple(ACRONYMS)).holds(F.col("name"), F.col("acronym"))
    return views.structures(b).select("id", "acronym", tag.alias("is_target"))


@register("cell_volume_um3_o27")
def _(b: Brain) -> DataFrame:
    um3 = F.lit(float(VOXEL_SIZE_UM[0] * VOXEL_SIZE_UM[1] * VOXEL_SIZE_UM[2]))
    per_cell = (F.col("volume_voxels") * um3).cast("float").cast("double")
    return views.cells(b).groupBy("biomarker").agg(F.sum(per_cell).alias("volume_um3"))


# --- scalar functions ---------------------------------------------------------


@register("native_to_atlas_o63")
def _(b: Brain) -> DataFrame:
    scaled = coords.native_to_atlas(b.native, b.atlas)
    return views.cells(b).select("cell_id", *[c.alias(f"a{a}") for a, c in zip(coords.AXES, scaled)])


@register("clamp_o64")
def _(b: Brain) -> DataFrame:
    shifted = views.cells(b).withColumns({"z": F.col("z") * 2 - 5, "y": F.col("y") * 2 - 9, "x": F.col("x") * 2 - 7})
    scaled = coords.native_to_atlas(b.native, b.atlas)
    kept = [coords.clamp(c, n).alias(f"a{a}") for a, c, n in zip(coords.AXES, scaled, b.atlas)]
    return shifted.select("cell_id", *kept)


@register("permute_axes_o8")
def _(b: Brain) -> DataFrame:
    return coords.permute(views.annotation(b), (2, 0, 1))


@register("path_parse_o70")
def _(b: Brain) -> DataFrame:
    path = F.col("structure_id_path")
    return views.structures(b).select(
        "id",
        ontology.path_depth(path).cast("bigint").alias("tier"),
        ontology.path_leaf(path).alias("leaf"),
        F.element_at(ontology.path_ids(path), 1).alias("root"),
    )


# --- joins --------------------------------------------------------------------


@register("structure_tallies_o31")
def _(b: Brain) -> DataFrame:
    tallies = report.cell_tallies(views.assigned_cells(b), "GFAP")
    joined = views.structures(b).select("id", "acronym").join(tallies, "id", "left")
    return joined.na.fill(0, ["total_cells", "left_cells", "right_cells"])


@register("region_lookup_o35")
def _(b: Brain) -> DataFrame:
    found = atlas.lookup_labels(views.cells(b), views.labels(b), b.native, b.atlas)
    return found.select("cell_id", "z", "y", "x", "found_region", "found_hemisphere")


@register("assign_regions_o36")
def _(b: Brain) -> DataFrame:
    cells = atlas.assign_regions(views.cells(b), views.labels(b), b.native, b.atlas, "TH")
    return cells.select("cell_id", "x", "biomarker", "region_id", "hemisphere_id")


@register("assigned_count_o36")
def _(b: Brain) -> DataFrame:
    return atlas.assigned_count(views.cells(b), "TH")


@register("points_in_mask_o37")
def _(b: Brain) -> DataFrame:
    points = views.cells(b).select("cell_id", "z", "y", (F.col("x") - 2).alias("x"))
    return coloc.points_in_mask(points, views.mask(b))


@register("colocalize_pair_o38")
def _(b: Brain) -> DataFrame:
    cells = coloc.colocalize_pair(views.filtered_cells(b), "TH", "cFos", views.mask(b))
    return cells.select("cell_id", "x", "volume_voxels", "biomarker", "colocalized_with_TH")


@register("colocalize_pairs_o39")
def _(b: Brain) -> DataFrame:
    masks = {larger: views.mask(b, larger) for larger in ("TH", "GFAP")}
    cells = coloc.colocalize_pairs(views.filtered_cells(b), PAIRS, masks)
    return cells.groupBy("biomarker", "colocalized_with_TH", "colocalized_with_GFAP").agg(F.count(F.lit(1)).alias("cells"))


@register("subtree_ids_o41")
def _(b: Brain) -> DataFrame:
    s = views.structures(b)
    return structures.subtree_ids(s, structures.find_region(s, "R1"))


# --- aggregations and reports -------------------------------------------------


@register("whole_brain_report_o44")
def _(b: Brain) -> DataFrame:
    return report.whole_brain_report(views.filtered_cells(b))


@register("region_tallies_o45")
def _(b: Brain) -> DataFrame:
    return report.cell_tallies(views.assigned_cells(b), "cFos")


@register("tier_rollup_o46")
def _(b: Brain) -> DataFrame:
    tallies = report.cell_tallies(views.assigned_cells(b), "cFos")
    rolled = structures.rollup_tiers(tallies, views.structures(b), ["total_cells", "left_cells", "right_cells"])
    return rolled.withColumn("tier", F.col("tier").cast("bigint"))


@register("region_voxels_hemi_o48")
def _(b: Brain) -> DataFrame:
    return report.region_voxel_counts(views.labels(b))


@register("region_voxels_midline_o48")
def _(b: Brain) -> DataFrame:
    return report.region_voxel_counts(views.labels(b), midline=b.atlas[2] // 2)


@register("geometry_report_o49")
def _(b: Brain) -> DataFrame:
    return _geometry(b).withColumn("tier", F.col("tier").cast("bigint"))


@register("coloc_tallies_o50")
def _(b: Brain) -> DataFrame:
    return coloc.coloc_tallies(_colocalized(b), "TH", "cFos")


@register("coloc_summary_o51")
def _(b: Brain) -> DataFrame:
    return coloc.coloc_summary(_colocalized(b), "TH", "cFos")


@register("coloc_report_o52")
def _(b: Brain) -> DataFrame:
    rolled = coloc.tiered_coloc_report(_colocalized(b), views.structures(b), "TH", "cFos")
    return rolled.withColumn("tier", F.col("tier").cast("bigint"))


@register("tiered_report_o53")
def _(b: Brain) -> DataFrame:
    return _cell_report(b).withColumn("tier", F.col("tier").cast("bigint"))


@register("target_summary_o59")
def _(b: Brain) -> DataFrame:
    tagged = report.target_summary(_cell_report(b), KEYWORDS, ACRONYMS, cell_threshold=THRESHOLD)
    return tagged.withColumn("Source_Tier", F.col("Source_Tier").cast("bigint"))


@register("density_o29")
def _(b: Brain) -> DataFrame:
    voxels = report.region_voxel_counts(views.labels(b)).select("id", "left_voxels")
    cells = report.cell_tallies(views.assigned_cells(b), "TH").select("id", "total_cells")
    return cells.join(voxels, "id", "left").select(
        "id", density(F.col("total_cells"), F.col("left_voxels") * F.lit(1.6e-08)).alias("cells_per_left_mm3")
    )


# --- detection ------------------------------------------------------------------


def _components(b: Brain, connectivity: int, merge: str = "exact") -> DataFrame:
    return components.components(views.voxels(b), b.meta, connectivity, merge, z_chunk=5)


@register("components_6_o47")
def _(b: Brain) -> DataFrame:
    return _components(b, 6)


@register("components_18_o47")
def _(b: Brain) -> DataFrame:
    return _components(b, 18)


@register("components_26_o47")
def _(b: Brain) -> DataFrame:
    return _components(b, 26)


@register("components_chunked_o47")
def _(b: Brain) -> DataFrame:
    return _components(b, 18, "chunked")


@register("components_small_bricks_o47")
def _(b: Brain) -> DataFrame:
    """Bricks of 16 voxels a side: most components cross faces, so the contact graph takes several rounds."""
    return components.components(views.voxels(b), b.meta, 18, brick=16)


@register("detect_cells_o47")
def _(b: Brain) -> DataFrame:
    return components.detect_cells(views.voxels(b), b.meta, "cFos", "B1", "r1", VOXEL_SIZE_UM).drop("region_id")


# --- volumes --------------------------------------------------------------------


def _up(b: Brain) -> tuple[int, int, int]:
    return (b.atlas[0] * 2 + 1, b.atlas[1] + 40, b.atlas[2] * 2)


def _down(b: Brain) -> tuple[int, int, int]:
    return (max(1, b.atlas[0] // 2), b.atlas[1] // 3, b.atlas[2] - 7)


@register("subvolume_o7")
def _(b: Brain) -> DataFrame:
    return volume.crop(views.annotation(b), (1, 10, 3), (b.atlas[0], 150, 20))


@register("relabel_subtree_o73")
def _(b: Brain) -> DataFrame:
    s = views.structures(b)
    return volume.select_region(views.annotation(b), s, structures.find_region(s, "R2"))


@register("region_has_voxels_o55")
def _(b: Brain) -> DataFrame:
    """Once for a region with voxels and once for the ids of the ontology that no voxel has."""
    s, voxels = views.structures(b), views.annotation(b)
    some = structures.subtree_ids(s, structures.find_region(s, "R3"))
    none = s.select("id").join(voxels.select(F.col("value").alias("id")), "id", "left_anti")
    rows = [
        volume.relabel(voxels, ids, 13).limit(1).agg(F.lit(name).alias("asked"), (F.count(F.lit(1)) > 0).alias("has_voxels"))
        for name, ids in (("R3", some), ("unused", none))
    ]
    return rows[0].unionByName(rows[1])


@register("resample_nearest_up_o74")
def _(b: Brain) -> DataFrame:
    return volume.resample(views.annotation(b), b.atlas, _up(b))


@register("resample_nearest_down_o74")
def _(b: Brain) -> DataFrame:
    return volume.resample(views.annotation(b), b.atlas, _down(b))


@register("resample_linear_up_o74")
def _(b: Brain) -> DataFrame:
    return volume.resample(views.annotation(b), b.atlas, _up(b), order=1)


@register("resample_linear_down_o74")
def _(b: Brain) -> DataFrame:
    return volume.resample(views.annotation(b), b.atlas, _down(b), order=1)


@register("scatter_o77")
def _(b: Brain) -> DataFrame:
    return volume.scatter(views.cells(b).withColumn("x", F.col("x") - 3), b.native)


@register("redraw_native_o78")
def _(b: Brain) -> DataFrame:
    return volume.redraw_native(views.filtered_cells(b), "TH", b.native)


@register("redraw_atlas_o79")
def _(b: Brain) -> DataFrame:
    cells = views.filtered_cells(b).withColumn("z", F.col("z") + 2)
    return volume.redraw_atlas(cells, "cFos", b.native, b.atlas)


@register("pyramid_levels_o83")
def _(b: Brain) -> DataFrame:
    levels = volume.pyramid(views.annotation(b), b.atlas)
    tagged = [level.withColumn("level", F.lit(k)) for k, level in enumerate(levels)]
    out = tagged[0]
    for level in tagged[1:]:
        out = out.unionByName(level)
    return out


@register("distinct_regions_o60")
def _(b: Brain) -> DataFrame:
    return views.assigned_cells(b).select("region_id").distinct()

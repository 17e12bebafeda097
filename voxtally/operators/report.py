"""Region geometry, cell tallies and tiered reports.

A report is one DataFrame with a ``tier`` column; it is split into sheets only
by the spreadsheet sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions import measures
from voxtally.functions.ontology import SystemRule
from voxtally.operators.stored_labels import StoredLabels, count_region_voxels
from voxtally.operators.structures import rollup_tiers
from voxtally.schema import HEMISPHERE_LEFT, HEMISPHERE_RIGHT

SIDES = ("total", "left", "right")


def region_voxel_counts(labels: DataFrame | StoredLabels, midline: int | None = None) -> DataFrame:
    """Voxels per region, in all and by side.

    ``labels`` is the table of :func:`voxtally.operators.atlas.label_table`, or
    stored volumes, which are counted box by box without a row for each voxel.
    With ``midline`` the side comes from ``x < midline`` instead of a label.
    """
    if isinstance(labels, StoredLabels):
        return count_region_voxels(labels, midline)
    if midline is None:
        left, right = F.col("hemisphere_id") == HEMISPHERE_LEFT, F.col("hemisphere_id") == HEMISPHERE_RIGHT
    else:
        left, right = F.col("x") < midline, F.col("x") >= midline
    return (
        labels.filter("region_id <> 0")
        .groupBy(F.col("region_id").cast("bigint").alias("id"))
        .agg(
            F.count(F.lit(1)).alias("total_voxels"),
            F.count_if(left).alias("left_voxels"),
            F.count_if(right).alias("right_voxels"),
        )
    )


def geometry_report(
    labels: DataFrame | StoredLabels,
    structures: DataFrame,
    voxel_size_um: tuple[float, float, float],
    midline: int | None = None,
) -> DataFrame:
    """Tiered voxel counts and volumes; computed once per brain."""
    voxels = [f"{s}_voxels" for s in SIDES]
    mm3 = voxel_size_um[0] * voxel_size_um[1] * voxel_size_um[2] * 1e-9
    rolled = rollup_tiers(region_voxel_counts(labels, midline), structures, voxels)
    return rolled.withColumns({f"{s}_volume_mm3": F.col(f"{s}_voxels") * F.lit(mm3) for s in SIDES})


def whole_brain_report(cells: DataFrame) -> DataFrame:
    return (
        cells.filter("passed_filter").groupBy("biomarker").agg(F.count(F.lit(1)).alias("total_cells")).orderBy("biomarker")
    )


def cell_tallies(cells: DataFrame, biomarker: str) -> DataFrame:
    """Passed cells per region; hemisphere 0 counts in the total only."""
    side = F.col("hemisphere_id")
    return (
        cells.filter((F.col("biomarker") == biomarker) & F.col("passed_filter") & F.col("region_id").isNotNull())
        .groupBy(F.col("region_id").cast("bigint").alias("id"))
        .agg(
            F.count(F.lit(1)).alias("total_cells"),
            F.count_if(side == HEMISPHERE_LEFT).alias("left_cells"),
            F.count_if(side == HEMISPHERE_RIGHT).alias("right_cells"),
        )
    )


def add_asymmetry(report: DataFrame) -> DataFrame:
    left, right = F.col("left_cells_per_mm3"), F.col("right_cells_per_mm3")
    return (
        report.withColumn("Diff_Percent", measures.diff_percent(left, right))
        .withColumn("Abs_Diff_Percent", F.abs("Diff_Percent"))
        .withColumn("Dominant_Side", measures.dominant_side(left, right))
        .withColumn("Signif_Diff_gt30pct", measures.significant(F.col("Abs_Diff_Percent")))
    )


def tiered_cell_report(cells: DataFrame, structures: DataFrame, geometry: DataFrame, biomarker: str) -> DataFrame:
    """Counts, volumes, densities and asymmetry of every structure."""
    rolled = rollup_tiers(cell_tallies(cells, biomarker), structures, [f"{s}_cells" for s in SIDES])
    volumes = geometry.select("tier", "structure_id", *[f"{s}_volume_mm3" for s in SIDES])
    joined = rolled.join(volumes, ["tier", "structure_id"], "left")
    dense = joined.withColumns(
        {f"{s}_cells_per_mm3": measures.density(F.col(f"{s}_cells"), F.col(f"{s}_volume_mm3")) for s in SIDES}
    )
    return add_asymmetry(dense)


def target_summary(
    report: DataFrame,
    keywords: list[str],
    acronyms: list[str],
    exact_acronym_match: bool = False,
    cell_threshold: int = 0,
) -> DataFrame:
    """Structures of one functional system over all tiers, largest asymmetry first."""
    tag = SystemRule.of(keywords, acronyms, exact_acronym_match).holds(F.col("structure_name"), F.col("acronym"))
    kept = report.filter(F.col("total_cells") >= cell_threshold) if cell_threshold > 0 else report
    return (
        kept.withColumnRenamed("tier", "Source_Tier")
        .withColumn("Is_Target_System", tag)
        .filter("Is_Target_System")
        .orderBy(F.desc_nulls_last("Abs_Diff_Percent"), F.desc("Source_Tier"), "structure_id")
    )

"""Volume filter: flags rows and never removes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _of_biomarker(biomarker: str | None) -> Column:
    return F.lit(True) if biomarker is None else F.col("biomarker") == biomarker


def apply_volume_filter(cells: DataFrame, biomarker: str | None, lo: int, hi: int) -> DataFrame:
    """Set ``passed_filter`` for one biomarker; both bounds are inclusive."""
    passed = F.when(_of_biomarker(biomarker), F.col("volume_voxels").between(lo, hi))
    return cells.withColumn("passed_filter", passed.otherwise(F.col("passed_filter")))


def filter_summary(cells: DataFrame, biomarker: str | None) -> DataFrame:
    """One row: ``total`` and ``passed`` cells of the biomarker."""
    return cells.filter(_of_biomarker(biomarker)).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("passed_filter")).alias("passed")
    )

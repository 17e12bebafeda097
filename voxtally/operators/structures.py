"""Ontology operators: subtree selection and the tier roll-up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.functions.ontology import path_depth, path_ids, path_leaf


@dataclass(frozen=True)
class Region:
    id: int
    name: str
    path: str


def find_region(structures: DataFrame, acronym: str) -> Region:
    """The structure carrying an acronym; the shallowest path wins on a tie."""
    row = (
        structures.filter(F.col("acronym") == acronym)
        .orderBy(F.length("structure_id_path"), "structure_id_path")
        .select("id", "name", "structure_id_path")
        .first()
    )
    if row is None:
        raise ValueError(f"no structure has the acronym {acronym!r}")
    return Region(int(row[0]), row[1], row[2])


def subtree_ids(structures: DataFrame, region: Region) -> DataFrame:
    """Distinct ids whose path contains the region's path, itself included."""
    inside = F.col("structure_id_path").contains(region.path)
    return structures.filter(inside).select(F.col("id").cast("bigint").alias("id")).distinct()


def structure_tiers(structures: DataFrame) -> DataFrame:
    """Tier (number of path segments) of every structure."""
    path = F.col("structure_id_path")
    return structures.select(
        path_depth(path).alias("tier"),
        path_leaf(path).alias("structure_id"),
        F.col("name").alias("structure_name"),
        "acronym",
    )


def rollup_tiers(tallies: DataFrame, structures: DataFrame, values: list[str]) -> DataFrame:
    """Cumulative self-plus-descendants sums for every structure.

    ``tallies`` holds one row per ``id``. Each row is sent to all ancestors on
    its path and summed there; the partial sums run before the shuffle, so the
    root, which receives every row, is no hot key. Ids outside the ontology
    drop out of the inner join.
    """
    paths = structures.select(F.col("id").cast("bigint").alias("id"), "structure_id_path")
    sums = (
        tallies.withColumn("id", F.col("id").cast("bigint"))
        .join(paths, "id")
        .select(F.explode(path_ids(F.col("structure_id_path"))).alias("structure_id"), *values)
        .groupBy("structure_id")
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    return (
        structure_tiers(structures)
        .join(sums, "structure_id", "left")
        .select("tier", "structure_id", "structure_name", "acronym", *[F.coalesce(v, F.lit(0)).alias(v) for v in values])
    )

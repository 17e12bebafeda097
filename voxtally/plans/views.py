"""Volume, cell and ontology views over the driver's star-schema tables.

Every view is derived from whole tables and grows with them: orders run along
the Z and Y axes of the native grid, so a tenfold table is a tenfold deeper
volume at the same density. All values are integers.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtally.operators import atlas, filtering
from voxtally.schema import CELL_SCHEMA, Shape, VolumeMeta

# Y and X extent of the native grid and of the atlas grid.
NATIVE_YX = (640, 96)
ATLAS_YX = (160, 24)
VOXEL_SIZE_UM = (4.0, 2.0, 2.0)
BOUNDS = (10, 45)
BIOMARKERS = ("cFos", "GFAP", "TH")


@dataclass(frozen=True)
class Brain:
    spark: SparkSession
    folder: str
    native: Shape
    atlas: Shape
    tables: dict[str, DataFrame] = field(default_factory=dict, compare=False)

    @property
    def meta(self) -> VolumeMeta:
        return VolumeMeta(self.native, "uint8")

    def table(self, name: str) -> DataFrame:
        """One DataFrame per table and query, so that its footer is read once."""
        if name not in self.tables:
            self.tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.tables[name]


@lru_cache(maxsize=16)
def _depth(application: str, folder: str) -> int:
    spark = SparkSession.active()
    top = spark.read.parquet(f"{folder}/orders.parquet").agg(F.max("o_orderkey")).first()[0]
    return int(top) // NATIVE_YX[0] + 1


def brain(spark: SparkSession, folder: str) -> Brain:
    depth = _depth(spark.sparkContext.applicationId, folder)
    return Brain(spark, folder, (depth, *NATIVE_YX), ((depth + 1) // 2, *ATLAS_YX))


def structures(b: Brain) -> DataFrame:
    """Four tiers: root, region, nation and one leaf per customer."""
    nation = b.table("nation")
    root = b.table("region").agg(F.min("r_regionkey")).selectExpr(
        "1L as id", "cast(null as bigint) as parent_structure_id", "'root' as acronym", "'Root' as name",
        "'/1/' as structure_id_path",
    )
    regions = b.table("region").selectExpr(
        "10L + r_regionkey", "1L", "concat('R', r_regionkey)", "r_name", "concat('/1/', 10 + r_regionkey, '/')"
    )
    nations = nation.selectExpr(
        "100L + n_nationkey", "10L + n_regionkey", "concat('N', n_nationkey)", "n_name",
        "concat('/1/', 10 + n_regionkey, '/', 100 + n_nationkey, '/')",
    )
    leaves = b.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "1000L + c_custkey", "100L + n_nationkey", "concat('C', c_custkey)", "c_name",
        "concat('/1/', 10 + n_regionkey, '/', 100 + n_nationkey, '/', 1000 + c_custkey, '/')",
    )
    return root.union(regions).union(nations).union(leaves)


def cells(b: Brain) -> DataFrame:
    """One unfiltered, unassigned cell per line item (``cell_id`` may repeat)."""
    return b.table("lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as cell_id",
        f"cast(l_orderkey div {NATIVE_YX[0]} as int) as z",
        f"cast(l_orderkey % {NATIVE_YX[0]} as int) as y",
        f"cast((l_partkey * 7 + l_suppkey * 13 + l_linenumber) % {NATIVE_YX[1]} as int) as x",
        "cast(l_quantity as int) as volume_voxels",
        "cast(cast(l_quantity as int) * 16.0D as float) as volume_um3",
        "case l_returnflag when 'R' then 'TH' when 'A' then 'GFAP' else 'cFos' end as biomarker",
        "cast(null as int) as region_id",
        "cast(0 as tinyint) as hemisphere_id",
        "'B1' as brain_id",
        "'r1' as run_id",
        "false as passed_filter",
    ).select(*CELL_SCHEMA.names)


def mask(b: Brain, biomarker: str = "TH") -> DataFrame:
    """Unfiltered mask of one channel: each of its cells and its two neighbours in X."""
    points = cells(b).filter(F.col("biomarker") == biomarker).select("z", "y", F.explode(F.expr("sequence(x - 1, x + 1)")).alias("x"))
    return points.filter(F.col("x").between(0, NATIVE_YX[1] - 1)).distinct().withColumn("value", F.lit(1).cast("bigint"))


def voxels(b: Brain) -> DataFrame:
    """Detection input: each line item is a run of one to three voxels."""
    return b.table("lineitem").selectExpr(
        f"cast(l_orderkey div {NATIVE_YX[0]} as int) as z",
        f"cast(l_orderkey % {NATIVE_YX[0]} as int) as y",
        f"cast((l_partkey * 7 + l_suppkey * 13 + l_linenumber) % {NATIVE_YX[1]} as int) as x0",
        "cast(l_quantity as int) % 3 as more",
    ).select("z", "y", F.explode(F.expr(f"sequence(x0, least(x0 + more, {NATIVE_YX[1] - 1}))")).alias("x"))


def labels(b: Brain) -> DataFrame:
    """Atlas regions and hemispheres: each order labels a run of eight voxels.

    Region 7 is not in the ontology; side 0 means not assigned.
    """
    (nz, ny, _), (az, ay, ax) = b.native, b.atlas
    runs = b.table("orders").selectExpr(
        f"cast((o_orderkey div {ny}) * {az} div {nz} as int) as z",
        f"cast((o_orderkey % {ny}) * {ay} div {ny} as int) as y",
        f"explode(sequence(o_custkey % {ax}, least(o_custkey % {ax} + 7, {ax - 1}))) as x",
        "o_custkey",
    )
    owner = F.col("owner")
    side = F.when(owner % 20 == 0, 0).when(F.col("x") < ax // 2, 1).otherwise(2)
    return (
        runs.groupBy("z", "y", F.col("x").cast("int").alias("x"))
        .agg(F.min("o_custkey").alias("owner"))
        .select(
            "z", "y", "x",
            F.when(owner % 50 == 0, F.lit(7).cast("bigint")).otherwise(owner + 1000).alias("region_id"),
            side.cast("bigint").alias("hemisphere_id"),
        )
    )


def annotation(b: Brain) -> DataFrame:
    return labels(b).select("z", "y", "x", F.col("region_id").alias("value"))


def filtered_cells(b: Brain) -> DataFrame:
    return filtering.apply_volume_filter(cells(b), None, *BOUNDS)


def assigned_cells(b: Brain) -> DataFrame:
    """Filtered cells with region and hemisphere."""
    return atlas.assign_regions(filtered_cells(b), labels(b), b.native, b.atlas)


def intensity(b: Brain) -> DataFrame:
    """A native intensity image: volumes of the cells on each voxel, added up."""
    return cells(b).groupBy("z", "y", "x").agg((F.sum("volume_voxels") * 100).alias("value"))

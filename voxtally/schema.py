"""Fixed schemas and constants shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Hemisphere labels (fixed values of the data model).
HEMISPHERE_NA = 0
HEMISPHERE_LEFT = 1
HEMISPHERE_RIGHT = 2

CELL_SCHEMA = T.StructType(
    [
        T.StructField("cell_id", T.LongType()),
        T.StructField("z", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("volume_voxels", T.IntegerType()),
        T.StructField("volume_um3", T.FloatType()),
        T.StructField("biomarker", T.StringType()),
        T.StructField("region_id", T.IntegerType()),
        T.StructField("hemisphere_id", T.ByteType()),
        T.StructField("brain_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("passed_filter", T.BooleanType()),
    ]
)

VOXEL_SCHEMA = T.StructType(
    [
        T.StructField("z", T.IntegerType()),
        T.StructField("y", T.IntegerType()),
        T.StructField("x", T.IntegerType()),
        T.StructField("value", T.LongType()),
    ]
)


def voxel_schema(dtype: str) -> T.StructType:
    """Voxels of a volume: real values stay real."""
    if not dtype.startswith("float"):
        return VOXEL_SCHEMA
    return T.StructType([*VOXEL_SCHEMA.fields[:3], T.StructField("value", T.DoubleType())])


# One dense box of a volume; ``data`` is C-ordered little-endian bytes.
BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("z0", T.IntegerType()),
        T.StructField("y0", T.IntegerType()),
        T.StructField("x0", T.IntegerType()),
        T.StructField("dz", T.IntegerType()),
        T.StructField("dy", T.IntegerType()),
        T.StructField("dx", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)

Shape = tuple[int, int, int]
Box = tuple[tuple[int, int], tuple[int, int], tuple[int, int]]


@dataclass(frozen=True)
class VolumeMeta:
    """Shape (Z, Y, X) and numpy dtype name of a volume; never holds voxels."""

    shape: Shape
    dtype: str

    @property
    def size_gb(self) -> float:
        import numpy as np

        z, y, x = self.shape
        return z * y * x * np.dtype(self.dtype).itemsize / 1024**3


def coloc_column(larger: str) -> str:
    return f"colocalized_with_{larger}"

"""Registered queries that write volumes or tables and read them back."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.config import build_config
from voxtally.functions.coords import permute, permute_shape
from voxtally.operators import atlas, coloc, components, report
from voxtally.operators.stored_labels import StoredLabels
from voxtally.operators.structures import find_region
from voxtally.plans import brain_runs, journal, views
from voxtally.plans.queries import register
from voxtally.plans.views import VOXEL_SIZE_UM, Brain
from voxtally.schema import VolumeMeta
from voxtally.session import shared_folder
from voxtally.sources import png, tables
from voxtally.sources.reader import Volume, open_volume
from voxtally.sources.writer import convert_volume, write_volume

ORDER = (1, 0, 2)
RUN_BOUNDS = (2, 60)


def _folder(b: Brain, name: str) -> str:
    return shared_folder(b.spark, name)


def _annotation(b: Brain, kind: str, **options) -> Volume:
    meta = VolumeMeta(b.atlas, "uint32")
    return open_volume(b.spark, write_volume(views.annotation(b), meta, _folder(b, "volume"), "annotation", kind, **options))


def _mask(b: Brain, kind: str = "zarr") -> Volume:
    voxels = views.voxels(b).distinct().withColumn("value", F.lit(1).cast("bigint"))
    return open_volume(b.spark, write_volume(voxels, b.meta, _folder(b, "volume"), "mask", kind))


@register("zarr_scan_o4")
def _(b: Brain) -> DataFrame:
    return _annotation(b, "zarr", chunk=(8, 64, 16)).voxels()


@register("tiff_scan_o2")
def _(b: Brain) -> DataFrame:
    return _annotation(b, "single-tiff").voxels()


@register("nifti_scan_o3")
def _(b: Brain) -> DataFrame:
    return _annotation(b, "single-nii").voxels()


@register("slice_folder_o6")
def _(b: Brain) -> DataFrame:
    return _annotation(b, "scroll-tiff").voxels()


@register("nifti_folder_o10e")
def _(b: Brain) -> DataFrame:
    return _annotation(b, "scroll-nii").voxels()


@register("ome_zarr_level_o10b")
def _(b: Brain) -> DataFrame:
    stored = _annotation(b, "ome-zarr", levels=2)
    levels = [open_volume(b.spark, os.path.join(stored.path, str(k))).voxels().withColumn("level", F.lit(k)) for k in (0, 1)]
    return levels[0].unionByName(levels[1])


@register("zarr_blosc_scan_o4")
def _(b: Brain) -> DataFrame:
    return _annotation(b, "zarr", chunk=(8, 64, 16), codec="blosc-lz4").voxels()


@register("slab_writes_o10")
def _(b: Brain) -> DataFrame:
    """One store, written in slabs that do not follow its chunks."""
    folder, cuts = _folder(b, "volume"), [0, 3, 5, b.atlas[0]]
    for a, z in zip(cuts, cuts[1:]):
        path = write_volume(views.annotation(b), VolumeMeta(b.atlas, "uint32"), folder, "slabs", "zarr", chunk=(4, 64, 16), z_range=(a, z))
    return open_volume(b.spark, path).voxels()


def _image_folder(b: Brain, voxels: DataFrame, dtype: str) -> DataFrame:
    """Each slice of an atlas-sized volume as a PNG, read back."""
    folder, shape = _folder(b, "images"), b.atlas[1:]
    os.makedirs(folder)

    def draw(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image = np.zeros(shape, dtype)
        for batch in batches:
            y, x, value = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "x", "value"))
            image[y[x >= 0], x[x >= 0]] = value[x >= 0]
        with open(os.path.join(folder, f"slice {key[0].as_py():09d}.png"), "wb") as f:
            f.write(png.encode(image))
        yield pa.RecordBatch.from_arrays([pa.array([image.size], pa.int64())], names=["pixels"])

    every = b.spark.range(b.atlas[0]).selectExpr("cast(id as int) z", "0 y", "-1 x", "0L value")
    voxels.unionByName(every).groupBy("z").applyInArrow(draw, "pixels bigint").count()
    return open_volume(b.spark, folder).voxels()


def _sides(b: Brain, factor: int) -> DataFrame:
    return views.labels(b).select("z", "y", "x", (F.col("hemisphere_id") * factor).alias("value")).filter("value <> 0")


def _stored_labels(b: Brain) -> StoredLabels:
    """Annotation and hemisphere stores of one shape with unlike chunks."""
    sides = write_volume(_sides(b, 1), VolumeMeta(b.atlas, "uint8"), _folder(b, "volume"), "sides", "zarr", chunk=(16, 40, 24))
    return StoredLabels(_annotation(b, "zarr", chunk=(8, 64, 16)), open_volume(b.spark, sides))


@register("region_lookup_stored_o35")
def _(b: Brain) -> DataFrame:
    found = atlas.lookup_labels(views.cells(b), _stored_labels(b), b.native, b.atlas)
    return found.select("cell_id", "z", "y", "x", "found_region", "found_hemisphere")


@register("region_voxels_stored_o48")
def _(b: Brain) -> DataFrame:
    return report.region_voxel_counts(_stored_labels(b))


@register("geometry_stored_o49")
def _(b: Brain) -> DataFrame:
    found = report.geometry_report(_stored_labels(b), views.structures(b), VOXEL_SIZE_UM)
    return found.withColumn("tier", F.col("tier").cast("bigint"))


@register("image_folder_o5")
def _(b: Brain) -> DataFrame:
    return _image_folder(b, _sides(b, 1), "uint8")


@register("image_folder_deep_o5")
def _(b: Brain) -> DataFrame:
    return _image_folder(b, _sides(b, 30_000), "uint16")


@register("float_mask_points_o37")
def _(b: Brain) -> DataFrame:
    """Points against a stored mask of real values, some of them negative; only chunks with points are read."""
    mask = views.mask(b).withColumn("value", F.when(F.col("x") % 3 == 0, -0.5).otherwise(0.7))
    path = write_volume(mask, VolumeMeta(b.native, "float32"), _folder(b, "volume"), "real", "zarr", chunk=(16, 64, 48))
    points = views.cells(b).select("cell_id", "z", "y", (F.col("x") - 2).alias("x"))
    return coloc.points_in_mask(points, open_volume(b.spark, path))


@register("atlas_to_native_o76")
def _(b: Brain) -> DataFrame:
    """An atlas stored as (Y, Z, X), read with its order, resized to native and summed up per slice."""
    turned = permute(views.annotation(b), ORDER)
    meta = VolumeMeta(permute_shape(b.atlas, ORDER), "uint32")
    source = write_volume(turned, meta, _folder(b, "volume"), "turned", "zarr")
    path = brain_runs.resample_to_native(b.spark, source, ORDER, b.native, _folder(b, "volume"), "native")
    return open_volume(b.spark, path).voxels().groupBy("z", "value").agg(
        F.count(F.lit(1)).alias("voxels"), F.sum("y").alias("sum_y"), F.sum("x").alias("sum_x")
    )


@register("extract_region_o80")
def _(b: Brain) -> DataFrame:
    s = views.structures(b)
    path = brain_runs.extract_region(_annotation(b, "zarr"), s, find_region(s, "R4"), b.native, _folder(b, "volume"), "R4")
    return open_volume(b.spark, path).voxels()


@register("registration_input_o82")
def _(b: Brain) -> DataFrame:
    source = write_volume(views.intensity(b), VolumeMeta(b.native, "uint32"), _folder(b, "volume"), "raw", "zarr")
    path = brain_runs.prepare_registration_input(b.spark, source, (2, 4, 6), ORDER, _folder(b, "volume"), "small")
    return open_volume(b.spark, path).voxels()


@register("box_read_o7")
def _(b: Brain) -> DataFrame:
    stored = _annotation(b, "zarr", chunk=(4, 32, 8))
    return stored.voxels((1, 10, 3), (b.atlas[0], 150, 20)).filter("y < 120 and x >= 5")


@register("permuted_read_o8")
def _(b: Brain) -> DataFrame:
    turned = permute(views.annotation(b), ORDER)
    meta = VolumeMeta(permute_shape(b.atlas, ORDER), "uint32")
    path = write_volume(turned, meta, _folder(b, "volume"), "turned", "zarr")
    return open_volume(b.spark, path, ORDER).voxels()


@register("convert_o12")
def _(b: Brain) -> DataFrame:
    stored = _annotation(b, "zarr")
    return open_volume(b.spark, convert_volume(stored, _folder(b, "volume"), "copy", "single-tiff")).voxels()


@register("components_of_blocks_o47")
def _(b: Brain) -> DataFrame:
    return components.components(_mask(b).blocks(), b.meta, 18)


@register("cells_scan_o14")
def _(b: Brain) -> DataFrame:
    path = os.path.join(_folder(b, "cells"), "cells.parquet")
    tables.write_cells(views.filtered_cells(b), path)
    return tables.read_cells(b.spark, path, "GFAP", True, ["cell_id", "z", "y", "x", "volume_voxels", "hemisphere_id"])


@register("structures_csv_o16")
def _(b: Brain) -> DataFrame:
    path = _folder(b, "structures")
    raw = views.structures(b).withColumn("parent_structure_id", F.col("parent_structure_id").cast("double"))
    raw.write.csv(path, header=True)
    return tables.read_structures(b.spark, path)


@register("structures_dirty_ids_o16")
def _(b: Brain) -> DataFrame:
    """Ids that are not numbers, too large or not finite read as 0."""
    path, number = _folder(b, "structures"), F.col("id") % 7
    odd = F.when(number == 0, "NaN").when(number == 1, "1e300").when(number == 2, "n/a").otherwise(F.col("id").cast("double").cast("string"))
    views.structures(b).withColumn("id", odd).write.csv(path, header=True)
    return tables.read_structures(b.spark, path).select("acronym", "id", "parent_structure_id")


@register("whole_brain_csv_o17")
def _(b: Brain) -> DataFrame:
    path = os.path.join(_folder(b, "report"), "whole.csv")
    tables.write_csv(report.whole_brain_report(views.filtered_cells(b)), path)
    return b.spark.read.csv(path, header=True, schema="biomarker string, total_cells bigint")


def _config(b: Brain, registered: bool):
    folder = _folder(b, "brain")
    lo, hi = RUN_BOUNDS
    mark = {"mask_path": _mask(b).path, "filter": {"min_volume_voxels": lo, "max_volume_voxels": hi}}
    raw = {
        "brain": {"id": "B1", "voxel_size_um": list(VOXEL_SIZE_UM), "needs_registration": registered},
        "biomarkers": {"cFos": mark},
        "paths": {"structures_csv": os.path.join(folder, "structures"), "output_dir": os.path.join(folder, "out")},
    }
    if registered:
        views.structures(b).write.csv(raw["paths"]["structures_csv"], header=True)
        side = views.labels(b).select("z", "y", "x", F.col("hemisphere_id").alias("value")).filter("value <> 0")
        hemisphere = write_volume(permute(side, ORDER), VolumeMeta(permute_shape(b.atlas, ORDER), "uint8"), folder, "side", "zarr")
        turned = permute(views.annotation(b), ORDER)
        annotation = write_volume(turned, VolumeMeta(permute_shape(b.atlas, ORDER), "uint32"), folder, "annotation", "single-tiff")
        raw["registration"] = {
            "annotation_path": annotation, "hemisphere_path": hemisphere, "downsample_factor": [2, 4, 4],
            "transpose_order": list(ORDER),
        }
    return build_config(yaml.safe_load(yaml.safe_dump(raw)))


@register("registered_brain_o88")
def _(b: Brain) -> DataFrame:
    """Every stage from stored volumes; the assigned cells of the run."""
    done = brain_runs.run_brain(b.spark, _config(b, True), roi_acronyms=["R1"])["cFos"]
    return tables.read_cells(b.spark, done["cells_path"]).select(
        "cell_id", "z", "y", "x", "volume_voxels", "region_id", "hemisphere_id", "passed_filter"
    )


@register("unregistered_brain_o89")
def _(b: Brain) -> DataFrame:
    """Every stage without an atlas; the voxels of the redrawn native mask."""
    done = brain_runs.run_brain(b.spark, _config(b, False))["cFos"]
    return open_volume(b.spark, done["redraw_path"]).voxels()


@register("run_journal_o90")
def _(b: Brain) -> DataFrame:
    """What the journal of a run says of each step: its outcome and the cells it counted."""
    done = brain_runs.run_brain(b.spark, _config(b, False))["cFos"]
    rows = journal.latest(journal.attempts(b.spark, os.path.dirname(done["cells_path"])), good=True)
    counted = F.coalesce(*[F.element_at("results", F.lit(k)) for k in ("cells_detected", "passed", "total_cells")])
    return rows.select("step", "outcome", counted.cast("bigint").alias("cells"))


@register("registered_outputs_o88")
def _(b: Brain) -> DataFrame:
    """Every stage with a region and a functional system; the voxels of both redraws and of the region."""
    system = {"keywords": ["a"], "acronyms": ["R2"]}
    done = brain_runs.run_brain(b.spark, _config(b, True), roi_acronyms=["R1"], functional_system=system)["cFos"]
    paths = {"native": done["redraw"]["native"], "atlas": done["redraw"]["atlas"], "roi": done["roi_extract"]["R1"]["output_path"]}
    parts = [open_volume(b.spark, path).voxels().withColumn("output", F.lit(kind)) for kind, path in paths.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("extract_many_o81")
def _(b: Brain) -> DataFrame:
    """Two regions and an acronym that the ontology does not have."""
    found = brain_runs.extract_regions(_annotation(b, "zarr"), views.structures(b), ["R1", "none", "R2"], b.native, _folder(b, "volume"))
    parts = [open_volume(b.spark, part["output_path"]).voxels().withColumn("acronym", F.lit(name)) for name, part in found.items()]
    return parts[0].unionByName(parts[1]).groupBy("acronym", "value", "z").agg(F.count(F.lit(1)).alias("voxels"))


@register("backups_o93")
def _(b: Brain) -> DataFrame:
    """A table written five times: the last three replaced ones are kept, oldest first."""
    path = os.path.join(_folder(b, "cells"), "cells.parquet")
    for least in range(0, 50, 10):
        tables.write_cells(views.cells(b).filter(F.col("volume_voxels") > least), path, stage="filter")
    kept = [*tables.list_backups(path, "filter"), path]
    parts = [b.spark.read.parquet(p).agg(F.lit(k).alias("age"), F.count(F.lit(1)).alias("cells")) for k, p in enumerate(kept)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

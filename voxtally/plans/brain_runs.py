"""Whole runs over one brain, as lists of steps.

A step names what it is made from and what it puts out; it is skipped while its
outputs are there and were made from the same things. Steps are lazy DataFrame
chains; cells are written once after detection and once after filtering and
assignment together.
"""

from __future__ import annotations

import logging
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voxtally.config import Settings
from voxtally.functions.boxes import block_rows
from voxtally.operators import atlas, coloc, filtering, report, volume
from voxtally.operators.components import detect_cells
from voxtally.operators.stored_labels import StoredLabels, stored_labels
from voxtally.operators.structures import Region, find_region, subtree_ids
from voxtally.plans import journal
from voxtally.schema import Shape, VolumeMeta
from voxtally.session import cut_lineage, scratch
from voxtally.sources import tables
from voxtally.sources.ids import stored_ids
from voxtally.sources.reader import Volume, open_volume
from voxtally.sources.writer import expected_output_path, write_resized, write_volume

log = logging.getLogger(__name__)


def extract_region(
    annotation: Volume,
    structures: DataFrame,
    region: Region,
    native: Shape,
    folder: str,
    name: str,
    output_type: str = "single-tiff",
    resize_order: int = 0,
    skip_existing: bool = True,
) -> str | None:
    """One region with its descendants at native resolution; None when it has no voxels.

    Every native box reads its atlas box, keeps the ids of the region and grows; no
    voxel becomes a row. The ids, which may be most of a large ontology, stay in
    files that tasks look them up in.
    """
    path = expected_output_path(str(folder), name, output_type)
    if skip_existing and os.path.exists(path):
        return path
    dtype = np.dtype(annotation.meta.dtype).newbyteorder("<")
    with stored_ids(subtree_ids(structures, region)) as ids:

        def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in block_rows(batch):
                    data = np.frombuffer(row["data"], dtype)
                    if ids.holds(data[data != 0]).any():
                        yield pa.RecordBatch.from_arrays([pa.array([row["z0"]], pa.int32())], names=["z0"])

        def chosen(data: np.ndarray) -> np.ndarray:
            return np.where(ids.holds(data), region.id, 0).astype(np.uint32)

        if annotation.blocks().mapInArrow(meets, "z0 int").isEmpty():
            log.warning("region %s (%d) has no voxels", region.name, region.id)
            return None
        return write_resized(annotation, native, str(folder), name, output_type, resize_order, None, chosen, "uint32")


def extract_regions(annotation: Volume, structures: DataFrame, acronyms: list[str], native: Shape, folder: str, **options) -> dict[str, dict]:
    """Several regions; unknown acronyms are logged and left out."""
    out = {}
    for acronym in acronyms:
        try:
            region = find_region(structures, acronym)
        except ValueError as error:
            log.warning("%s", error)
            continue
        path = extract_region(annotation, structures, region, native, folder, f"{acronym}_atlas", **options)
        out[acronym] = {"id": region.id, "name": region.name, "output_path": path}
    return out


@dataclass
class Atlas:
    """What all biomarkers of a registered brain share."""

    annotation: Volume
    labels: DataFrame | StoredLabels
    structures: DataFrame
    geometry: DataFrame
    has_sides: bool

    @property
    def shape(self) -> Shape:
        return self.annotation.meta.shape


@dataclass
class Desk:
    """One biomarker on its way through the steps; steps leave what the next ones need."""

    spark: SparkSession
    config: Settings
    mark: Settings
    folder: Path
    atlas: Atlas | None = None
    roi: list[str] = field(default_factory=list)
    system: dict = field(default_factory=dict)
    out: dict = field(default_factory=dict)
    filtered: DataFrame | None = None

    @cached_property
    def mask(self) -> Volume:
        return open_volume(self.spark, self.mark.mask_path)

    @property
    def cells_path(self) -> str:
        return str(self.folder / "cells.parquet")

    def cells(self, *columns: str, passed: bool | None = None) -> DataFrame:
        return tables.read_cells(self.spark, self.cells_path, self.mark.name if columns else None, passed, list(columns) or None)

    def file(self, suffix: str) -> str:
        return str(self.folder / f"{self.mark.name}_{suffix}")


@dataclass(frozen=True)
class Step:
    """``work`` does it and returns results; with ``made_from`` it is skipped while ``outputs`` are current."""

    name: str
    work: Callable[[Desk], dict]
    made_from: Callable[[Desk], str] | None = None
    outputs: Callable[[Desk], list[str]] = lambda desk: []
    wanted: Callable[[Desk], bool] = lambda desk: True


def detect(desk: Desk) -> dict:
    mask, how, brain, run_id = desk.mask, desk.mark.detection, desk.config.brain, uuid.uuid4().hex[:8]
    found = detect_cells(
        mask.blocks(), mask.meta, desk.mark.name, brain.id, run_id, brain.voxel_size_um,
        connectivity=how.connectivity, merge=how.merge, z_chunk=how.z_chunk,
    )
    tables.write_cells(found, desk.cells_path)
    return {"run_id": run_id, "cells_detected": desk.cells().count()}


def filter_cells(desk: Desk) -> dict:
    bounds = desk.mark.filter
    desk.filtered = filtering.apply_volume_filter(desk.cells(), desk.mark.name, bounds.min_volume_voxels, bounds.max_volume_voxels)
    if desk.atlas is None:
        tables.write_cells(desk.filtered, desk.cells_path, stage="filter")
        desk.filtered = desk.cells()
    desk.out["filter"] = filtering.filter_summary(desk.filtered, desk.mark.name).first().asDict()
    return desk.out["filter"]


def assign_cells(desk: Desk) -> dict:
    shared = desk.atlas
    halves = desk.config.registration.cells_midline and not shared.has_sides
    cells = atlas.assign_regions(desk.filtered, shared.labels, desk.mask.meta.shape, shared.shape, desk.mark.name, halves)
    tables.write_cells(cells, desk.cells_path, stage="filter")
    desk.out["assign_regions"] = atlas.assigned_count(desk.cells(), desk.mark.name).first().asDict()
    return desk.out["assign_regions"]


def report_regions(desk: Desk) -> dict:
    shared, target = desk.atlas, None
    tiered = cut_lineage(report.tiered_cell_report(desk.cells(), shared.structures, shared.geometry, desk.mark.name), "report")
    if desk.system:
        words = {"keywords": [], "acronyms": [], "exact_acronym_match": False, "cell_threshold": 0}
        target = report.target_summary(tiered, *[desk.system.get(k, default) for k, default in words.items()])
    path = desk.out["report_path"] = desk.file("region_report.xlsx")
    tables.write_tiered_report(tiered, path, target)
    return {"report_path": path}


def report_brain(desk: Desk) -> dict:
    path = desk.out["report_path"] = desk.file("whole_brain_report.csv")
    tables.write_csv(report.whole_brain_report(desk.cells()), path)
    return {"report_path": path, "total_cells": desk.cells().filter("passed_filter").count()}


def extract_rois(desk: Desk) -> dict:
    shared = desk.atlas
    found = extract_regions(shared.annotation, shared.structures, desk.roi, desk.mask.meta.shape, str(desk.folder / "roi_extract"))
    desk.out["roi_extract"] = found
    return {name: str(part["output_path"]) for name, part in found.items()}


def redraw_outputs(desk: Desk) -> dict[str, tuple[str, str, Shape]]:
    """By kind: name, storage and shape of each redraw."""
    kinds = {"native": (f"{desk.mark.name}_redraw_native", "scroll-tiff", desk.mask.meta.shape)}
    if desk.atlas:
        kinds["atlas"] = (f"{desk.mark.name}_redraw_atlas", "zarr", desk.atlas.shape)
    return kinds


def redraw_paths(desk: Desk) -> dict[str, str]:
    return {kind: expected_output_path(str(desk.folder), name, storage) for kind, (name, storage, _) in redraw_outputs(desk).items()}


def redraw_cells(desk: Desk) -> DataFrame:
    return desk.cells("biomarker", "passed_filter", "z", "y", "x", passed=True)


def redraw(desk: Desk) -> dict:
    native = desk.mask.meta.shape
    for kind, (name, storage, shape) in redraw_outputs(desk).items():
        cells = redraw_cells(desk)
        drawn = volume.redraw_native(cells, desk.mark.name, shape) if kind == "native" else volume.redraw_atlas(cells, desk.mark.name, native, shape)
        write_volume(drawn, VolumeMeta(shape, "uint8"), str(desk.folder), name, storage)
    return redraw_paths(desk)


DETECT = Step("detect", detect)
FILTER = Step("filter", filter_cells)
REDRAW = Step(
    "redraw", redraw,
    made_from=lambda desk: f"{journal.cells_digest(redraw_cells(desk))} {sorted(redraw_outputs(desk).items())}",
    outputs=lambda desk: list(redraw_paths(desk).values()),
)
REGISTERED = (
    DETECT, FILTER, Step("assign_regions", assign_cells), Step("report", report_regions),
    Step("roi_extract", extract_rois, wanted=lambda desk: bool(desk.roi)), REDRAW,
)
UNREGISTERED = (DETECT, FILTER, Step("report", report_brain), REDRAW)


def run_steps(desk: Desk, steps: tuple[Step, ...]) -> dict:
    spark, folder = desk.spark, desk.folder
    folder.mkdir(parents=True, exist_ok=True)
    for step in steps:
        if not step.wanted(desk):
            continue
        made_from = step.made_from(desk) if step.made_from else ""
        # Detection is current while its table is whole: later steps rewrite that table.
        current = tables.is_complete(spark, desk.cells_path) if step is DETECT else step.made_from and journal.is_current(spark, folder, step.name, made_from, step.outputs(desk))
        if current:
            log.info("%s: %s is current", desk.mark.name, step.name)
            continue
        with journal.attempt(spark, folder, step.name, {"biomarker": desk.mark.name, "mask_path": desk.mark.mask_path}, made_from) as results:
            results.update(step.work(desk))
    journal.export(spark, folder)
    return {"cells_path": desk.cells_path, **desk.out}


def run_registered(
    spark: SparkSession,
    config: Settings,
    output_dir=None,
    roi_acronyms: list[str] | None = None,
    functional_system: dict | None = None,
) -> dict:
    """All biomarkers of a brain with an annotation.

    Volumes are atlas voxels times ``voxel_size_um`` of the native grid unless
    ``registration.atlas_voxel_size_um`` gives the true size of an atlas voxel.
    """
    if not config.brain.needs_registration:
        raise ValueError(f"brain {config.brain.id} is not registered")
    reg = config.registration
    structures = tables.read_structures(spark, config.paths.structures_csv)
    annotation = open_volume(spark, reg.annotation_path, reg.transpose_order)
    sides = open_volume(spark, reg.hemisphere_path, reg.transpose_order) if reg.hemisphere_path else None
    labels = stored_labels(annotation, sides)
    if labels is None:
        labels = cut_lineage(atlas.label_table(annotation.voxels(), sides.voxels() if sides else None), "labels")
    midline = None if sides else annotation.meta.shape[2] // 2
    geometry = cut_lineage(report.geometry_report(labels, structures, reg.atlas_voxel_size_um or config.brain.voxel_size_um, midline), "geometry")
    shared = Atlas(annotation, labels, structures, geometry, sides is not None)
    results = {}
    for name, mark in config.biomarkers.items():
        desk = Desk(spark, config, mark, Path(output_dir or config.paths.output_dir) / name, shared, roi_acronyms or [], functional_system or {})
        results[name] = {"roi_extract": None, **run_steps(desk, REGISTERED), "redraw": redraw_paths(desk)}
    return results


def run_unregistered(spark: SparkSession, config: Settings, output_dir=None) -> dict:
    """All biomarkers of a brain without an annotation: whole-brain counts only."""
    if config.brain.needs_registration:
        raise ValueError(f"brain {config.brain.id} is registered")
    results = {}
    for name, mark in config.biomarkers.items():
        desk = Desk(spark, config, mark, Path(output_dir or config.paths.output_dir) / name)
        results[name] = {**run_steps(desk, UNREGISTERED), "redraw_path": redraw_paths(desk)["native"]}
    return results


def run_brain(spark: SparkSession, config: Settings, output_dir=None, roi_acronyms=None, functional_system=None) -> dict:
    """Either run; the tables it wrote on the way are deleted when its outputs are there."""
    with scratch(spark):
        if config.brain.needs_registration:
            return run_registered(spark, config, output_dir, roi_acronyms, functional_system)
        if roi_acronyms or functional_system:
            log.warning("brain %s is not registered: regions and functional system are ignored", config.brain.id)
        return run_unregistered(spark, config, output_dir)


def colocalize_tables(spark: SparkSession, pairs, cells_paths: dict[str, str], mask_paths: dict[str, str]) -> dict:
    """Test each (larger, smaller) pair and keep the flag in the smaller one's table."""
    out = {}
    for larger, smaller in pairs:
        path = cells_paths[smaller]
        flagged = coloc.colocalize_pair(tables.read_cells(spark, path), larger, smaller, open_volume(spark, mask_paths[larger]))
        tables.write_cells(flagged, path, stage="colocalize")
        out[larger, smaller] = coloc.coloc_summary(tables.read_cells(spark, path), larger, smaller).first().asDict()
    return out


def prepare_registration_input(
    spark: SparkSession, source, factor: Shape, order, folder: str, name: str, resize_order: int = 1
) -> str:
    """Downsample a reference channel, permute its axes and store it as Zarr, in one pass over its target."""
    raw = open_volume(spark, source)
    return write_resized(raw, volume.registration_shape(raw.meta.shape, factor), folder, name, "zarr", resize_order, order)


def resample_to_native(
    spark: SparkSession, source, order, native: Shape, folder: str, name: str, output_type="single-tiff", resize_order: int = 0
) -> str:
    """An atlas-space volume at native size and axis order."""
    return write_resized(open_volume(spark, source, order), native, folder, name, output_type, resize_order)

"""Whole runs, table files, configuration and journals."""

import json
import xml.etree.ElementTree as ET
import zipfile
from pathlib import Path

import numpy as np
import pytest
import yaml

from voxtally import __main__ as cli
from voxtally.config import ConfigError, biomarker, build_config, load_config
from voxtally.plans import brain_runs, journal
from voxtally.schema import VolumeMeta
from voxtally.session import shared_dir
from voxtally.sources import tables
from voxtally.sources.reader import open_volume
from voxtally.sources.writer import write_volume

NATIVE = (12, 20, 20)
CSV = 'acronym,id,name,structure_id_path,parent_structure_id\nROOT,1,Root,/1/,\nA,10.0,"Region A, left",/1/10/,1.0\nB,20,Region B,/1/20/,1.0\n'


def store(spark, folder, name, array):
    rows = [(*map(int, p), int(array[tuple(p)])) for p in np.argwhere(array)]
    voxels = spark.createDataFrame(rows, "z int, y int, x int, value bigint")
    return write_volume(voxels, VolumeMeta(array.shape, array.dtype.name), str(folder), name, "zarr", chunk=(4, 20, 20))


def raw_config(tmp_path, mask, annotation=None, hemisphere=None):
    raw = {
        "brain": {"id": "B7", "voxel_size_um": [4.0, 2.0, 2.0], "needs_registration": annotation is not None},
        "biomarkers": {
            "cFos": {
                "mask_path": mask,
                "detection": {"connectivity": 18, "z_chunk": 5},
                "filter": {"min_volume_voxels": 30, "max_volume_voxels": 100},
            }
        },
        "paths": {"structures_csv": str(tmp_path / "structures.csv"), "output_dir": str(tmp_path / "out")},
    }
    if annotation:
        raw["registration"] = {"annotation_path": annotation, "downsample_factor": [3, 4, 4], "transpose_order": [1, 0, 2]}
        if hemisphere:
            raw["registration"]["hemisphere_path"] = hemisphere
    return raw


def sheets(path):
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(path) as z:
        names = [s.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{ns}sheet")]
        out = {}
        for k, name in enumerate(names, start=1):
            root = ET.fromstring(z.read(f"xl/worksheets/sheet{k}.xml"))
            out[name] = [["".join(c.itertext()) for c in row] for row in root.iter(f"{ns}row")]
    return out


def test_registered_run(spark, tmp_path):
    mask = np.zeros(NATIVE, "uint8")
    mask[5:9, 5:9, 1:5] = mask[5:9, 5:9, 15:19] = mask[0:2, 0:2, 0:2] = 1
    annotation = np.zeros((5, 4, 5), "uint32")
    annotation[:, :, :2], annotation[:, :, 2:] = 10, 20
    sides = np.where(annotation == 10, 1, 2).astype("uint8")
    (tmp_path / "structures.csv").write_text(CSV)
    paths = [store(spark, tmp_path, n, a) for n, a in (("mask", mask), ("annotation", annotation), ("sides", sides))]
    config = build_config(raw_config(tmp_path, *paths))
    system = {"keywords": [], "acronyms": ["A", "B"], "exact_acronym_match": True}
    done = brain_runs.run_brain(spark, config, roi_acronyms=["A", "nope"], functional_system=system)["cFos"]
    assert done["filter"] == {"total": 3, "passed": 2} and done["assign_regions"] == {"assigned": 3}
    cells = tables.read_cells(spark, done["cells_path"], "cFos", True)
    assert {(r.region_id, r.hemisphere_id, r.volume_voxels) for r in cells.collect()} == {(10, 1, 64), (20, 2, 64)}
    book = sheets(done["report_path"])
    assert list(book) == ["Target_Summary", "Tier 1", "Tier 2"]
    assert book["Tier 1"][0][:4] == ["structure_id", "structure_name", "acronym", "total_cells"] and book["Tier 1"][1][3] == "2"
    assert book["Tier 2"][1][1] == "Region A, left"
    assert set(done["roi_extract"]) == {"A"}
    roi = open_volume(spark, done["roi_extract"]["A"]["output_path"])
    assert roi.meta == VolumeMeta(NATIVE, "uint32")
    assert roi.voxels().groupBy("value").count().collect() == [(10, 12 * 20 * 8)]
    assert open_volume(spark, done["redraw"]["atlas"]).voxels().count() == 2
    assert open_volume(spark, done["redraw"]["native"]).meta.shape == NATIVE

    folder = tmp_path / "out" / "cFos"
    again = brain_runs.run_brain(spark, config)["cFos"]
    assert again["redraw"] == done["redraw"] and again["roi_extract"] is None
    tried = {r.step: r["count"] for r in journal.attempts(spark, folder).groupBy("step").count().collect()}
    assert tried == {"detect": 1, "filter": 2, "assign_regions": 2, "report": 2, "roi_extract": 1, "redraw": 1}
    assert len(list((folder / "logs").glob("redraw-*.log"))) == 1
    assert len(tables.list_backups(done["cells_path"], "filter")) == 2
    assert json.loads((folder / "manifest.json").read_text())["stages"]["report"]["outcome"] == "done"

    # An annotation of another shape draws the atlas mask again.
    wider = np.zeros((6, 10, 10), "uint32")
    wider[:, :, :5], wider[:, :, 5:] = 10, 20
    store(spark, tmp_path, "annotation", wider)
    raw = raw_config(tmp_path, *paths[:2])
    third = brain_runs.run_brain(spark, build_config(raw))["cFos"]
    assert open_volume(spark, third["redraw"]["atlas"]).meta.shape == (10, 6, 10)
    assert journal.attempts(spark, folder).filter("step = 'redraw'").count() == 2


def test_unregistered_run_and_cli(spark, tmp_path, capsys):
    mask = np.zeros(NATIVE, "uint8")
    mask[0:3, 0:3, 0:3] = mask[5:9, 5:9, 5:9] = mask[9:12, 10:13, 10:13] = 1
    raw = raw_config(tmp_path, store(spark, tmp_path, "mask", mask))
    before = set(Path(shared_dir(spark)).iterdir())
    (tmp_path / "brain.yaml").write_text(yaml.safe_dump(raw))
    assert cli.main([str(tmp_path / "brain.yaml"), "--roi", "A", "--log-level", "ERROR"]) == 0
    done = json.loads(capsys.readouterr().out)["cFos"]
    assert set(Path(shared_dir(spark)).iterdir()) == before
    assert done["filter"] == {"total": 3, "passed": 1}
    assert open(done["report_path"]).read() == "biomarker,total_cells\ncFos,1\n"
    drawn = open_volume(spark, done["redraw_path"]).voxels().collect()
    assert [tuple(r) for r in drawn] == [(6, 6, 6, 255)]

    # A cut-off cells table is detected again; a new threshold redraws.
    (tmp_path / "out" / "cFos" / "cells.parquet" / "_SUCCESS").unlink()
    raw["biomarkers"]["cFos"]["filter"]["min_volume_voxels"] = 20
    again = brain_runs.run_brain(spark, build_config(raw))["cFos"]
    assert again["filter"] == {"total": 3, "passed": 3}
    tried = [r.step for r in journal.attempts(spark, tmp_path / "out" / "cFos").collect()]
    assert tried.count("detect") == 2 and tried.count("redraw") == 2
    assert open_volume(spark, again["redraw_path"]).voxels().count() == 3
    with pytest.raises(ValueError):
        brain_runs.run_registered(spark, build_config(raw))

    flagged = brain_runs.colocalize_tables(
        spark, [("TH", "cFos")], {"cFos": again["cells_path"]}, {"TH": raw["biomarkers"]["cFos"]["mask_path"]}
    )
    assert flagged == {("TH", "cFos"): {"tested": 3, "colocalized": 3}}
    assert "colocalized_with_TH" in tables.read_cells(spark, again["cells_path"]).columns


def test_empty_mask_run(spark, tmp_path):
    raw = raw_config(tmp_path, store(spark, tmp_path, "mask", np.zeros((2, 3, 4), "uint8")))
    done = brain_runs.run_brain(spark, build_config(raw))["cFos"]
    assert done["filter"] == {"total": 0, "passed": 0}
    assert open(done["report_path"]).read() == "biomarker,total_cells\n"


def test_volume_entry_points(spark, tmp_path):
    raw = np.zeros((20, 40, 60), "uint16")
    raw[4:8, 8:16, 12:24] = 1000
    path = store(spark, tmp_path, "raw", raw)
    small = brain_runs.prepare_registration_input(spark, path, (2, 4, 6), (1, 0, 2), str(tmp_path), "small")
    assert open_volume(spark, small).meta == VolumeMeta((10, 10, 10), "uint16")
    native = brain_runs.resample_to_native(spark, small, (1, 0, 2), (20, 40, 60), str(tmp_path), "back")
    back = open_volume(spark, native)
    assert back.meta == VolumeMeta((20, 40, 60), "uint16")
    assert back.voxels().filter("z = 6 and y = 12 and x = 18").first().value == 1000


def test_structures_and_cells_files(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(CSV + "HATA,5.89508447e8,Hippo,/1/589508447/,1\nbad,x1,Bad,/1/0/,1\n")
    rows = {r.acronym: (r.id, r.parent_structure_id) for r in tables.read_structures(spark, path).collect()}
    assert rows["HATA"] == (589508447, 1) and rows["bad"] == (0, 1) and rows["ROOT"] == (1, None) and rows["A"][0] == 10
    with pytest.raises(ValueError, match="region_id"):
        tables.write_cells(spark.createDataFrame([(1,)], "cell_id bigint"), str(tmp_path / "c.parquet"))
    assert not tables.is_complete(spark, tmp_path / "none.parquet")


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda r: r.pop("brain"), "brain"),
        (lambda r: r["brain"].update(voxel_size_um=[1, 2]), "voxel_size_um"),
        (lambda r: r["brain"].update(needs_registration="false"), "needs_registration"),
        (lambda r: r["brain"].update(needs_registration=True), "registration section"),
        (lambda r: r.update(biomarkers={}), "biomarker"),
        (lambda r: r["biomarkers"]["cFos"]["filter"].update(min_volume_voxels=100), "below"),
        (lambda r: r.update(registration={}), "registration"),
        (lambda r: r.update(colocalization={"pairs": [{"larger": "TH", "smaller": "cFos"}]}), "TH"),
        (lambda r: r["paths"].pop("output_dir"), "output_dir"),
    ],
)
def test_config_errors(tmp_path, change, message):
    raw = raw_config(tmp_path, "m.tif")
    change(raw)
    with pytest.raises(ConfigError, match=message):
        build_config(raw)


def test_config_order_and_defaults(tmp_path):
    raw = raw_config(tmp_path, "m.tif", "a.tif")
    raw["registration"]["transpose_order"] = [2, 0, 1]
    with pytest.raises(ConfigError, match="self-inverse"):
        build_config(raw)
    own = raw_config(tmp_path, "m.tif")
    del own["biomarkers"]["cFos"]["filter"]["max_volume_voxels"]
    shared = {"biomarkers": {n: {"filter": {"min_volume_voxels": 1, "max_volume_voxels": 77}} for n in ("cFos", "TH")}}
    for name, content in (("own", own), ("shared", shared)):
        (tmp_path / f"{name}.yaml").write_text(yaml.safe_dump(content))
    config = load_config(tmp_path / "own.yaml", tmp_path / "shared.yaml")
    assert list(config.biomarkers) == ["cFos"]
    bounds = biomarker(config, "cFos").filter
    assert (bounds.min_volume_voxels, bounds.max_volume_voxels) == (30, 77)
    assert config.biomarkers.cFos.detection.merge == "exact" and config.colocalization.pairs == ()
    with pytest.raises(ConfigError):
        biomarker(config, "TH")


def test_journal(spark, tmp_path):
    assert journal.attempts(spark, tmp_path).count() == 0 and not journal.is_current(spark, tmp_path, "detect", "x", [])
    with journal.attempt(spark, tmp_path, "detect", {"mask": "m"}, "x") as results:
        results["n"] = 3
    with pytest.raises(RuntimeError), journal.attempt(spark, tmp_path, "detect", {}, "y"):
        raise RuntimeError("boom")
    found = journal.export(spark, tmp_path)
    assert found["stages"]["detect"]["results"] == {"n": "3"} and found["last_attempt"]["detect"]["error"] == "RuntimeError: boom"
    assert json.loads((tmp_path / "manifest.json").read_text()) == found
    assert journal.is_current(spark, tmp_path, "detect", "x", [str(tmp_path)])
    assert not journal.is_current(spark, tmp_path, "detect", "y", []) and not journal.is_current(spark, tmp_path, "detect", "x", ["/no"])
    logs = [p.read_text() for p in (tmp_path / "logs").iterdir()]
    assert len(logs) == 2 and sum("boom" in text for text in logs) == 1

"""Cells, structures and report files."""

from __future__ import annotations

import csv
import os
import shutil
import time
import uuid
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtally.schema import CELL_SCHEMA

KEEP_BACKUPS = 3


# --- cells ----------------------------------------------------------------------


def check_cells(cells: DataFrame) -> DataFrame:
    """Cast to the fixed schema; extra colocalisation columns are kept."""
    missing = [f.name for f in CELL_SCHEMA.fields if f.name not in cells.columns]
    if missing:
        raise ValueError(f"cells lack {', '.join(missing)}")
    extra = [c for c in cells.columns if c not in CELL_SCHEMA.names]
    return cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CELL_SCHEMA.fields], *extra)


def write_cells(cells: DataFrame, path: str, stage: str | None = None, keep: int = KEEP_BACKUPS) -> None:
    """Write next to the target, then swap it in; an empty table is written too.

    With ``stage`` the table that is replaced is backed up under that stage first.
    """
    path = str(path)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    temp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
    check_cells(cells).write.parquet(temp)
    if stage and os.path.exists(path):
        back_up(path, stage, keep)
    swap_in(temp, path)


def swap_in(temp: str, path: str) -> None:
    """Give a written table its name; what it replaces is deleted only when the new one is in place."""
    old = f"{path}.old-{uuid.uuid4().hex[:8]}"
    if os.path.lexists(path):
        os.replace(path, old)
    try:
        os.replace(temp, path)
    except OSError:
        if os.path.lexists(old):
            os.replace(old, path)
        raise
    if os.path.isdir(old):
        shutil.rmtree(old)
    elif os.path.lexists(old):
        os.unlink(old)


def recover(path: str) -> None:
    """Put back a table whose replacement was cut off between the two renames of :func:`swap_in`."""
    folder, name = os.path.split(str(path))
    if os.path.isdir(folder) and not os.path.lexists(path):
        for left in [n for n in os.listdir(folder) if n.startswith(f"{name}.old-")][:1]:
            os.replace(os.path.join(folder, left), path)


def backup_folder(path: str) -> str:
    stem = os.path.splitext(os.path.basename(path))[0]
    return os.path.join(os.path.dirname(path), f"{stem}_backups")


def list_backups(path: str, stage: str) -> list[str]:
    folder = backup_folder(str(path))
    names = os.listdir(folder) if os.path.isdir(folder) else []
    return [os.path.join(folder, n) for n in sorted(names) if n.startswith(f"{stage}-")]


def back_up(path: str, stage: str, keep: int = KEEP_BACKUPS) -> str:
    """Keep the table under its stage before it is replaced; its files are linked, not copied.

    Names are ordered by one clock reading and a number that settles ties.
    """
    folder, now = backup_folder(path), time.time_ns()
    os.makedirs(folder, exist_ok=True)
    last = [int(os.path.basename(b).split("-")[-1].split(".")[0]) for b in list_backups(path, stage)]
    target = os.path.join(folder, f"{stage}-{max([now, *(n + 1 for n in last)]):020d}.parquet")
    if os.path.isdir(path):
        shutil.copytree(path, target, copy_function=_linked)
    else:
        _linked(path, target)
    for old in list_backups(path, stage)[:-keep]:
        shutil.rmtree(old) if os.path.isdir(old) else os.unlink(old)
    return target


def _linked(source: str, target: str) -> None:
    try:
        os.link(source, target)
    except OSError:
        shutil.copy2(source, target)


def read_cells(
    spark: SparkSession,
    path: str,
    biomarker: str | None = None,
    passed_filter: bool | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Scan with filter and column pushdown; ``path`` is a table or a folder of tables."""
    names = sorted(os.listdir(path)) if os.path.isdir(path) else []
    nested = [os.path.join(path, n) for n in names if n.endswith(".parquet") and os.path.isdir(os.path.join(path, n))]
    reader = spark.read.option("mergeSchema", "true") if nested else spark.read
    cells = reader.parquet(*(nested or [str(path)]))
    if biomarker is not None:
        cells = cells.filter(F.col("biomarker") == biomarker)
    if passed_filter is not None:
        cells = cells.filter(F.col("passed_filter") == passed_filter)
    return cells.select(*columns) if columns else cells


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a cells table was written to its end and its schema reads; never raises."""
    try:
        recover(path)
        if not os.path.exists(path):
            return False
        if os.path.isdir(path) and not os.path.exists(os.path.join(path, "_SUCCESS")):
            return False
        return set(CELL_SCHEMA.names) <= set(spark.read.parquet(str(path)).columns)
    except Exception:
        return False


# --- structures -------------------------------------------------------------------


def clean_structures(raw: DataFrame) -> DataFrame:
    """Numeric ids written as text or floats become BIGINT, unreadable ones 0."""

    def whole(column: str):
        return F.expr(f"try_cast(try_cast({column} as double) as bigint)")

    return raw.withColumns(
        {"id": F.coalesce(whole("id"), F.lit(0)), "parent_structure_id": whole("parent_structure_id")}
    )


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(str(path), header=True, quote='"', escape='"')
    return clean_structures(raw)


# --- reports ----------------------------------------------------------------------


def _atomic(path: str):
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    return f"{path}.tmp-{uuid.uuid4().hex[:8]}"


def write_csv(report: DataFrame, path: str) -> None:
    """One CSV file in row order; rows are streamed partition by partition."""
    temp = _atomic(str(path))
    with open(temp, "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(report.columns)
        for row in report.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
    os.replace(temp, path)


def _column(k: int) -> str:
    name = ""
    while True:
        name = chr(65 + k % 26) + name
        k = k // 26 - 1
        if k < 0:
            return name


def _sheet_row(number: int, values: Iterable) -> str:
    cells = []
    for k, v in enumerate(values):
        ref = f"{_column(k)}{number}"
        if v is None:
            continue
        if isinstance(v, bool):
            cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float)) and v == v and abs(v) != float("inf"):
            cells.append(f'<c r="{ref}"><v>{v!r}</v></c>')
        else:
            cells.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>')
    return f'<row r="{number}">{"".join(cells)}</row>'


_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def write_xlsx(sheets: Iterable[tuple[str, DataFrame]], path: str) -> list[str]:
    """A workbook with one sheet per table, rows streamed; returns the sheet names."""
    temp = _atomic(str(path))
    names = []
    with zipfile.ZipFile(temp, "w", zipfile.ZIP_DEFLATED) as z:
        for name, table in sheets:
            names.append(name)
            with z.open(f"xl/worksheets/sheet{len(names)}.xml", "w", force_zip64=True) as f:
                f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                f.write(_sheet_row(1, table.columns).encode())
                for k, row in enumerate(table.toLocalIterator(), start=2):
                    f.write(_sheet_row(k, row).encode())
                f.write(b"</sheetData></worksheet>")
        numbered = list(enumerate(names, start=1))
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in numbered)
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{listed}</sheets></workbook>')
        links = "".join(
            f'<Relationship Id="rId{k}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k, _ in numbered
        )
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
        z.writestr(
            "_rels/.rels",
            f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" '
            f'Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        )
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(
            f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k, _ in numbered
        )
        z.writestr(
            "[Content_Types].xml",
            f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" '
            f'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>',
        )
    os.replace(temp, path)
    return names


def write_tiered_report(report: DataFrame, path: str, target_summary: DataFrame | None = None) -> list[str]:
    """``Target_Summary`` first when it has rows, then one sheet per tier."""
    tiers = [r[0] for r in report.select("tier").distinct().orderBy("tier").collect()]
    sheets = []
    if target_summary is not None and not target_summary.isEmpty():
        sheets.append(("Target_Summary", target_summary))
    for tier in tiers:
        rows = report.filter(F.col("tier") == tier).drop("tier").orderBy("structure_id")
        sheets.append((f"Tier {tier}", rows))
    return write_xlsx(sheets, path)


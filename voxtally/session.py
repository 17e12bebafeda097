"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "voxtally", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of the session."""
    _ship(spark.sparkContext.applicationId)


@lru_cache(maxsize=4)
def _ship(application: str) -> None:
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="voxtally-code-")) / "voxtally_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A session without one gets a fresh local folder, which is right only in
    local mode; a cluster session must name its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="voxtally-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, stem: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{stem}-{uuid.uuid4().hex[:12]}")


def shared_folder(spark: SparkSession, stem: str) -> str:
    """A new path below the shared folder as the file system of every node sees it."""
    path = shared_path(spark, stem)
    local = path.removeprefix("file://").removeprefix("file:")
    if "://" in local:
        raise ValueError(f"volume files need a mounted folder, spark.checkpoint.dir is {path}")
    return local


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have; names differ by more than case."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


_OWNED: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the tables that :func:`cut_lineage` writes inside, and delete them at the end.

    For work that ends in a sink; a DataFrame that leaves the context may still read them.
    """
    owned: list[str] = []
    _OWNED.append(owned)
    try:
        yield
    finally:
        _OWNED.remove(owned)
        for path in owned:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame, stem: str = "step") -> DataFrame:
    """Write to the shared folder and read back.

    The written table outlives any executor, is computed once, and is read with
    column pruning by each later use.
    """
    path = shared_path(df.sparkSession, stem)
    if _OWNED:
        _OWNED[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table that :func:`cut_lineage` wrote and nothing reads any more."""
    spark = df.sparkSession
    root = shared_dir(spark)
    base = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().startswith(base):
            _delete(spark, folder)

"""Session settings and the one place where intermediate results are stored."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_CONF = "parley.scratch.root"
# Codec of tables that hold whole texts: two thirds of the space of the default one.
TEXT_CODEC = "zstd"
_scope: ContextVar[list[str] | None] = ContextVar("scratch_paths", default=None)


def build_session(app_name: str = "parley", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC and AQE with skew handling."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, has a folder of its own
    where the setting is missing; it goes with the process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    known = spark.conf.get(_SCRATCH_CONF, None)
    if known:
        return known
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="parley-scratch-")
    atexit.register(shutil.rmtree, fallback, ignore_errors=True)
    spark.conf.set(_SCRATCH_CONF, fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    paths = _scope.get()
    if paths is not None:
        paths.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def bucketed_table(spark: SparkSession, path: str, columns: str, bucket_by: str, buckets: int, partition: str) -> str:
    """The name of a table over ``path`` (its files, now or later) that is bucketed by one column and partitioned by another.

    Its files are in place, and so is its name's only meaning: a join or grouping by the bucket column reads it without a shuffle.
    """
    name = f"parley_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}, `{partition}` INT) USING parquet PARTITIONED BY (`{partition}`) "
        f"CLUSTERED BY (`{bucket_by}`) SORTED BY (`{bucket_by}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if path_exists(spark, path):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def swap_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``. Until the last step the old one stays beside it, see recover_folder."""
    recover_folder(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    old, target = hadoop(f"{path}.old"), hadoop(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"cannot move {path}")
    if not files.rename(hadoop(fresh), target):
        raise OSError(f"cannot move {fresh}")
    files.delete(old, True)


def recover_folder(spark: SparkSession, path: str) -> None:
    """Undo or finish a swap that was cut off."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    old, target = hadoop(f"{path}.old"), hadoop(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(old):
        if files.exists(target):
            files.delete(old, True)
        else:
            files.rename(old, target)


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside; use it around work whose results are written inside."""
    token = _scope.set([])
    try:
        yield
    finally:
        for path in _scope.get() or []:
            delete_path(spark, path)
        _scope.reset(token)


def materialize(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage, so a lost executor re-reads files instead of redoing the work, and gives
    later joins real size statistics.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("error").option("compression", TEXT_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

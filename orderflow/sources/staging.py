"""Intermediate results on shared storage, and row counts observed on the writes themselves."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from orderflow.functions.hashing import with_packed_hash, with_unpacked_hash

_open_scopes: list[list[tuple[SparkSession, str]]] = []
_AQE_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_EMPTY_RELATIONS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CODEC = "spark.sql.parquet.compression.codec"


def work_root(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local session may leave it unset: then it is a
    folder beside the warehouse, which other machines would not see."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-work"
    return root.rstrip("/")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def lean_jobs(spark: SparkSession) -> Iterator[None]:
    """Jobs planned inside leave little on disk.

    Their shuffle files go when they end, not when the driver next collects garbage, and what they write
    is compressed by zstd (the digits of hashes to half), unless the session names a codec.
    """
    codec = spark.conf.get(_CODEC, None) or "zstd"
    with setting(spark, _SHUFFLE_CLEANUP, "true"), setting(spark, _CODEC, codec):
        yield


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and the number of its rows that the next ``counted_write`` reads."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def observed_rows(seen: Observation) -> int:
    """Rows that went through an observed frame in a finished write."""
    return seen.get["rows"]


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return the rows it wrote, counted on the way.

    While it runs, adaptive execution must not replace an input it finds empty by an empty relation:
    it would remove an observing node below a shuffle, and its count (zero) with it.
    """
    spark = df.sparkSession
    counted, seen = observed(df)
    excluded = spark.conf.get(_AQE_EXCLUDED, None)
    rules = f"{excluded},{_EMPTY_RELATIONS}" if excluded else _EMPTY_RELATIONS
    with setting(spark, _AQE_EXCLUDED, rules), lean_jobs(spark):
        write(counted)
    return observed_rows(seen)


def _staged_path(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    path = f"{work_root(spark)}/orderflow/{application}/{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append((spark, path))
    return path


def stage(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame to the work folder and read it back (runs a job).

    The copy survives the loss of any executor, cuts lineage, and has a file size the planner
    knows, so a later join broadcasts it only when it really is small. Copies are grouped by
    application and dropped at the end of the ``staging_scope`` they were made in, if there is one.
    Content hashes are kept as bytes in the copy, or left out where they can be computed again.
    """
    spark = df.sparkSession
    path = _staged_path(spark)
    kept = with_packed_hash(df)
    with lean_jobs(spark):
        kept.write.partitionBy(*partition_by).parquet(path)
    return with_unpacked_hash(spark.read.schema(kept.schema).parquet(path), df.schema)


def stage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``stage``, and the number of rows, from the same write."""
    spark = df.sparkSession
    path = _staged_path(spark)
    kept = with_packed_hash(df)
    rows = counted_write(kept, lambda counted: counted.write.parquet(path))
    return with_unpacked_hash(spark.read.schema(kept.schema).parquet(path), df.schema), rows


def discard(copy: DataFrame) -> None:
    """Drop a staged copy before its scope ends; nothing may read it any more."""
    for folder in {unquote(file.rpartition("/")[0]) for file in copy.inputFiles()}:
        delete_folder(copy.sparkSession, folder)


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system a path is on, and the path as that file system takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    system, target = file_system(spark, path)
    system.delete(target, True)


@contextmanager
def staging_scope() -> Iterator[None]:
    """Drop the copies staged inside; frames that read them must have been written or collected."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for spark, path in _open_scopes.pop():
            delete_folder(spark, path)

"""Helpers shared by the operators: code on the executors, scratch tables, texts in Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from orderflow.sources.staging import delete_folder, work_root

# Rows of one Arrow batch are cut into slices of at most this many text bytes (or one row).
SLICE_BYTES = 4 << 20
_open_scopes: list[list[tuple[SparkSession, str]]] = []


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_orderflow_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="orderflow-code-"), "orderflow_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    context._orderflow_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster shares."""
    application = spark.sparkContext.applicationId
    return f"{work_root(spark)}/orderflow-llm/{application}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back (runs a job, cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _open_scopes:
        _open_scopes[-1].append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Delete what is stored inside; frames that read it must have been written elsewhere."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for spark, path in _open_scopes.pop():
            delete_folder(spark, path)


def drop_stored(*frames: DataFrame) -> None:
    """Delete tables written by ``store`` that nothing reads any more."""
    for frame in frames:
        delete_folder(frame.sparkSession, frame.inputFiles()[0].rpartition("/")[0])


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores appended until no column of the frame has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8_list(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow string column as UTF-8 bytes (binary values as they are)."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = pa.large_binary() if large else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batch: pa.RecordBatch, index: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold about ``size`` bytes of the given text column each."""
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(index)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def scan_texts(
    df: DataFrame,
    text_col: str,
    keep: Iterable[str],
    scan: Callable[[list[bytes | None]], list[list | np.ndarray | pa.Array]],
    schema: str,
    result: str = "scan",
    slice_bytes: int = SLICE_BYTES,
) -> tuple[DataFrame, str]:
    """Run ``scan`` over all texts and append its outputs as one struct column.

    ``scan`` gets the UTF-8 texts of a slice (None for null) and returns one list per field of
    ``schema`` (a DDL string). The columns in ``keep`` pass through. The struct's name, returned
    beside the frame, is ``result`` with underscores appended if a kept column already has it.
    """
    spark = df.sparkSession
    ship_package(spark)
    keep = list(keep)
    kept = df.select(*keep)
    name = free_name(kept, result)
    # The text travels under a name of its own, so a kept column may be the text itself.
    text = free_name(kept, "text_")
    column = df[text_col]
    if not isinstance(df.schema[text_col].dataType, T.BinaryType):
        column = column.cast("string")
    source = df.select(*keep, column.alias(text))
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow(fields)
    full = T.StructType([*kept.schema.fields, T.StructField(name, fields)])
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, width, slice_bytes):
                outputs = scan(utf8_list(part.column(width)))
                arrays = [
                    value if isinstance(value, pa.Array) else pa.array(value, type=field.type)
                    for value, field in zip(outputs, arrow, strict=True)
                ]
                struct = pa.StructArray.from_arrays(arrays, fields=list(arrow))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], struct], names=[*part.schema.names[:width], name]
                )

    return source.mapInArrow(run, full), name


def to_arrow(fields: T.StructType) -> pa.StructType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(fields)

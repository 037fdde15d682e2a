"""Readers for raw files and tables. Paths may be on any file system Spark is configured for."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T

from orderflow.sources.staging import file_system

CORRUPT_RECORD = "_corrupt_record"
# Bytes of a file that are looked at for its header; more only if the header is longer.
HEADER_BYTES = 16 << 10
HEADER_READERS = 16


def first_record(data: bytes) -> bytes | None:
    """The first record that is not blank, without its line end; None if the bytes end inside it.

    Line breaks between quotes belong to the record; a backslash escapes the next byte.
    """
    quoted = escaped = False
    start = 0
    for at, byte in enumerate(data):
        if escaped:
            escaped = False
        elif byte == 0x5C:
            escaped = True
        elif byte == 0x22:
            quoted = not quoted
        elif byte == 0x0A and not quoted:
            record = data[start:at].rstrip(b"\r")
            if record.strip():
                return record
            start = at + 1
    return None


def _header(spark: SparkSession, file: str) -> bytes:
    """The header of a file, from its first bytes only."""
    system, path = file_system(spark, file)
    stream = system.open(path)
    try:
        data, size = b"", HEADER_BYTES
        while True:
            more = bytes(stream.readNBytes(size))
            data += more
            found = first_record(data)
            if found is not None:
                return found
            if len(more) < size:
                return first_record(data + b"\n") or b""
            size = len(data)
    finally:
        stream.close()


def _files_by_header(spark: SparkSession, path: str) -> dict[bytes, list[str]]:
    """The feed's files, those with the same header together.

    The driver reads a few kilobytes of each listed file, many files at a time; no job runs.
    """
    files = sorted(unquote(file) for file in spark.read.text(path).inputFiles())
    groups: dict[bytes, list[str]] = {}
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        for file, header in zip(files, readers.map(lambda file: _header(spark, file), files), strict=True):
            if header:
                groups.setdefault(header, []).append(file)
    return groups


def read_csv(
    spark: SparkSession, path: str, contract: T.StructType | None = None
) -> DataFrame:
    """Read a CSV feed with a header row in every file.

    With a contract there is no inference pass over the data. The columns of each file are named by
    its own header, so they may come in any order and extra ones (an update time) are kept as text;
    files with different headers are read apart and united by column name. Names may be quoted and
    hold line breaks. Values that do not fit become NULL and their line is kept in ``_corrupt_record``. Without a contract the types are
    inferred, which is how the raw contract is checked.
    """
    reader = spark.read.option("header", True)
    if contract is None:
        return reader.option("inferSchema", True).csv(path)
    groups = _files_by_header(spark, path)
    if not groups:
        empty = T.StructType([*contract.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
        return spark.createDataFrame([], empty)
    types = {field.name: field.dataType for field in contract.fields}
    parts = []
    for header, files in groups.items():
        # Files with line breaks in quotes cannot be split, so only those are read that way.
        options = {"header": True, "multiLine": b"\n" in header}
        names = spark.read.options(**options).csv(files[0]).columns
        fields = [T.StructField(name, types.get(name, T.StringType())) for name in names]
        schema = T.StructType([*fields, T.StructField(CORRUPT_RECORD, T.StringType())])
        parts.append(
            spark.read.options(**options)
            .schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
            .csv(path if len(groups) == 1 else files)
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A Parquet path when it looks like one, else a catalog table."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan of fewer tasks than there are cores to all of them, before heavy work on its rows.

    A file of one row group is one task whatever its size. A scan with at least as many splits as
    cores, which is every large one, is left alone. Filters and column selections still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

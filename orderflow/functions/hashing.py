"""Content hashes and source timestamps used to decide which record version wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderflow.functions.values import as_timestamp
from orderflow.schemas import ORDER_COLUMNS

NULL_MARKER = "<NULL>"
SEPARATOR = "||"
HASH_BYTES = 32
# Before the bytes of a text that is no content hash, so that these are longer than a hash's.
_OTHER = bytes(HASH_BYTES + 1)
SOURCE_TIMESTAMP_COLUMNS = ("update_timestamp", "updated_at", "source_update_ts")


def _hash_text(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        # The text of a binary float differs between Java releases; decimal text does not.
        text = F.coalesce(value.try_cast("decimal(38,10)").cast("string"), value.cast("string"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(NULL_MARKER))


def record_hash(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 over the named columns in the given order; absent columns are left out."""
    parts = [_hash_text(df.schema[name]) for name in columns if name in df.columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def packed_hash(column: Column | str = "record_hash") -> Column:
    """A content hash as its 32 bytes, for shuffles, joins and files; its 64 digits do not compress.

    Any other text is kept too, so packed values are equal where the texts are. NULL stays NULL.
    """
    text = F.col(column) if isinstance(column, str) else column
    raw = F.unhex(text)
    is_hash = (F.octet_length(text) == 2 * HASH_BYTES) & (F.lower(F.hex(raw)) == text)
    return F.when(is_hash, raw).otherwise(F.concat(F.lit(_OTHER), text.cast("binary")))


def unpacked_hash(column: Column | str = "record_hash") -> Column:
    """The text that ``packed_hash`` was given."""
    raw = F.col(column) if isinstance(column, str) else column
    other = F.substring(raw, len(_OTHER) + 1, 2**31 - 1).cast("string")
    return F.when(F.octet_length(raw) == HASH_BYTES, F.lower(F.hex(raw))).otherwise(other)


def hash_digest(column: Column | str = "record_hash") -> Column:
    """16 bytes that stand for a content hash, or any other text, where it is only compared."""
    text = F.col(column) if isinstance(column, str) else column
    return F.unhex(F.md5(text.cast("string")))


def same_content(*frames: DataFrame) -> bool:
    """Whether the frames hold all columns of an order, each in the same type, so that a row's content
    hash is the same in each of them and in their union."""
    held = [{field.name: field.dataType for field in df.schema.fields} for df in frames]
    return all(name in kinds and kinds[name] == held[0][name] for kinds in held for name in ORDER_COLUMNS)


def with_packed_hash(df: DataFrame, derived: bool = True) -> DataFrame:
    """The frame with its ``record_hash``, if it has one as text, packed in place.

    Of an order whose hash is that of the row's own columns nothing is kept but a mark (no bytes), and
    ``with_unpacked_hash`` computes it again; any other hash is kept as its bytes. Until then these
    columns must keep their values and types, or ``derived`` be off.
    """
    field = df.schema["record_hash"] if "record_hash" in df.columns else None
    if field is None or not isinstance(field.dataType, T.StringType):
        return df
    packed = packed_hash()
    if derived and same_content(df):
        packed = F.when(F.col("record_hash") == record_hash(df, ORDER_COLUMNS), F.lit(b"")).otherwise(packed)
    return df.withColumn("record_hash", packed)


def with_unpacked_hash(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame as it was, in the given schema, before ``with_packed_hash``."""
    if "record_hash" not in df.columns or df.schema["record_hash"].dataType == schema["record_hash"].dataType:
        return df
    text = unpacked_hash()
    if same_content(df):
        marked = F.octet_length("record_hash") == 0
        text = F.when(marked, record_hash(df, ORDER_COLUMNS)).otherwise(text)
    return df.withColumn("record_hash", text)


def source_timestamp(df: DataFrame, default: Column) -> Column:
    """The first known update-time column the frame has, else the given default."""
    for name in SOURCE_TIMESTAMP_COLUMNS:
        if name in df.columns:
            return as_timestamp(name)
    return default

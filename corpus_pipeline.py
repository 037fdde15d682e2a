"""The corpus pipeline: raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the stages' results
are written as Parquet and read again in between. All but the last return the columns of ``documents``.
Nulls in any column are allowed: a document without text is scored and encoded like an empty one, and
near copies are decided row by row, so that repeated ids and rows without id are like any others. Very long
texts go through whole. Other columns, whatever their names and types, pass through all stages but the last,
whose result has columns of its own. Empty documents give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow.llm import bpe, decontaminate, pii, quality, simhash
from orderflow.llm.common import drop_stored, scratch_path, scratch_scope
from orderflow.llm.queries import PATTERN, RANKS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; it is trained on these documents' labels."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of each group of near copies, one without id only if none has any."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark text."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and secrets in the texts; ``n_chars`` follows the text."""
    masked = pii.mask_documents(docs)
    if "n_chars" not in masked.columns:
        return masked
    kind = masked.schema["n_chars"].dataType
    length = F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
    return masked.withColumn("n_chars", length).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    done, ids, text = bpe.round_trip(docs, RANKS, PATTERN, ["doc_id"])
    return done.select(
        "doc_id",
        (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        F.col(ids).alias("ids"),
        F.col(text).alias("text"),
    )


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("byte-level BPE", encode),
]
# SQL cannot express SimHash, the classifiers and BPE; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        # What a stage stored, and its input, are deleted once its result is written.
        with scratch_scope():
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before is not None:
            drop_stored(before)
        before = docs
    return docs

"""Registered queries of the operators; each applies one to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderflow.llm import (
    bpe,
    codebooks,
    decontaminate,
    hamming,
    licenses,
    lines,
    merkle,
    pii,
    quality,
    simhash,
    substrings,
    unigram,
    warc,
)
from orderflow.llm.common import scratch_path, store

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
NEIGHBOURS = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.archive(warc.records(_table(spark, sf_dir, "pages")), path)
    return warc.parse(warc.restore(spark, path)).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = hamming.sign_codes(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return hamming.nearest_codes(codes, codes.where("id % 50 = 0"), NEIGHBOURS)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    hexes = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexes.alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    done, ids, text = bpe.round_trip(documents, RANKS, PATTERN, ["doc_id"])
    return done.select(
        "doc_id",
        (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col(ids), 256).alias("ids_sha256"),
        F.sha2(F.col(text).cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    proposed, name = pii.propose(_table(spark, sf_dir, "documents"), ["doc_id"])
    stored = store(proposed, "pii-candidates")
    weights = pii.train(pii.count_votes(stored, name))
    spans = pii.decide(F.col(name), weights)
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return stored.select(
        "doc_id",
        *[count(kind) for kind in pii.BASE],
        F.sha2(pii.render(base), 256).alias("base_sha256"),
        pii.render(spans).alias("spans"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    network = quality.train(documents, labels)
    scored, name = quality.score_documents(documents, network, ["doc_id"])
    score = F.col(f"{name}.score")
    return scored.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        score.alias("score"),
        (score >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    counted, name = unigram.count_tokens(documents, RANKS, PATTERN, ["doc_id"])
    return counted.select("doc_id", f"{name}.n_tokens", f"{name}.score")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = licenses.train(licenses.sample_negatives(documents), licenses.sample_candidates(documents))
    scanned, name = licenses.scan(documents, model, ["doc_id"])
    families = F.array_sort(F.array_distinct(F.transform(name, lambda p: p["family"])))
    return scanned.select(
        "doc_id",
        F.size(name).cast("long").alias("n_paragraphs"),
        F.array_join(families, ",").alias("families"),
        F.array_join(F.transform(name, lambda p: p["paragraph"].cast("string")), ",").alias("at"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    scanned, hits = decontaminate.scan_documents(documents, benchmark, ["doc_id"])
    items = F.col(f"{hits}.items")
    return scanned.select(
        "doc_id",
        f"{hits}.n_words",
        f"{hits}.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        decontaminate.contaminated(hits).alias("contaminated"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", merkle.UPPER, merkle.LOWER)
    changed = merkle.leaf(*[lowered if name == "text" else F.col(name) for name in columns])
    found = merkle.leaves(documents, columns, presented=F.when(tampered, changed))
    proven = merkle.verify(merkle.proofs(merkle.build(found)))
    return proven.select(
        F.col("leaf_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op12_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, name, books = codebooks.encode(_table(spark, sf_dir, "embeddings"), ["vec_id", "label"])
    errors = codebooks.group_errors(coded, name, "label").withColumnRenamed("label", "error_label")
    digest = hashlib.sha256(codebooks.text_of(books).encode()).hexdigest()
    return coded.join(errors, F.col("label").eqNullSafe(F.col("error_label"))).select(
        "vec_id",
        F.lower(F.hex(f"{name}.code")).alias("code"),
        F.col(f"{name}.error").alias("error"),
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    cut, name = lines.drop_frequent_lines(documents, ["doc_id"])
    return cut.select(
        "doc_id",
        f"{name}.n_lines",
        f"{name}.n_dropped",
        F.sha2(F.col(f"{name}.kept").cast("binary"), 256).alias("kept_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_topk_search": op2_topk_search,
    "op3_simhash": op3_simhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_pii": op6_pii,
    "op7_quality": op7_quality,
    "op8_token_counts": op8_token_counts,
    "op9_licenses": op9_licenses,
    "op10_decontamination": op10_decontamination,
    "op11_merkle": op11_merkle,
    "op12_codebooks": op12_codebooks,
    "op13_line_dedup": op13_line_dedup,
}

"""Texts of some megabytes through the operators: their last words count like the first."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import decontaminate, lines, merkle, quality, simhash, substrings, warc

PASSAGE = " ".join(f"passage{k}" for k in range(60))
ITEM = " ".join(f"question{k}" for k in range(15))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    words = np.array([f"w{k}" for k in range(50_000)])
    long = "\n".join(" ".join(words[rng.integers(0, 50_000, 100)]) for _ in range(6_000))
    return [(1, f"{long}\n{PASSAGE}"), (2, f"short {PASSAGE} end"), (3, f"{long[::-1]}\n{ITEM}"), (4, "menu"), (5, None)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(2)


def test_substrings(docs, texts):
    found = {r.doc_id: r for r in substrings.repeated_passages(docs).collect()}
    assert {i: r.n_removed for i, r in found.items()} == {1: 0, 2: 60, 3: 0, 4: 0, 5: 0}
    assert found[1].n_words == 600_060
    assert found[2].kept_sha256 == hashlib.sha256(b"short end").hexdigest()
    assert found[1].kept_sha256 == hashlib.sha256(" ".join(texts[0][1].split()).encode()).hexdigest()


def test_decontamination(spark, docs, texts):
    benchmark = spark.createDataFrame([("q", ITEM)], "item_id string, text string")
    scanned, hits = decontaminate.scan_documents(docs, benchmark, ["doc_id"])
    found = {r.doc_id: r[hits] for r in scanned.collect()}
    assert {i: r.n_hit for i, r in found.items()} == {1: 0, 2: 0, 3: 15, 4: 0, 5: 0}
    span = found[3].spans[0]
    assert texts[2][1][span.start : span.end] == ITEM


def test_quality_and_fingerprints(spark, docs, texts):
    network = quality.fit([b"good words here", b"BAD!! BAD!!"] * 20, np.array([1, 0] * 20, np.float32), 30)
    scored, name = quality.score_documents(docs, network, ["doc_id"])
    expected = network.score([(t or "").encode() for _, t in texts])
    got = {r.doc_id: r[name].score for r in scored.collect()}
    assert all(abs(got[i] - s) < 1e-6 for (i, _), s in zip(texts, expected, strict=True))
    prints = {r.doc_id: r.fp for r in simhash.near_duplicates(docs).collect()}
    assert prints[1] & (2**64 - 1) == simhash.simhash(texts[0][1].encode())


def test_archive(spark, docs, texts, tmp_path):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    path = str(tmp_path / "a")
    warc.archive(warc.records(pages), path)
    found = {r.id: (r.payload_bytes, r.payload_digest) for r in warc.parse(warc.restore(spark, path)).collect()}
    assert found == {
        i: (len((t or "").encode()), hashlib.sha1((t or "").encode()).hexdigest()) for i, t in texts
    }


def test_lines_and_manifest(docs, texts):
    cut, name = lines.drop_frequent_lines(docs, ["doc_id"], min_documents=2)
    found = {r.doc_id: r[name] for r in cut.collect()}
    assert (found[1].n_lines, found[1].n_dropped, found[1].kept) == (6_001, 0, texts[0][1])
    placed = merkle.leaves(docs.withColumn("source", F.lit("s")), ["doc_id", "text"])
    proven = merkle.verify(merkle.proofs(merkle.build(placed))).collect()
    assert len(proven) == 5 and all(r.verified for r in proven)
    leaf = next(r.leaf for r in proven if r.leaf_id == 1)
    text = texts[0][1]
    assert leaf == hashlib.sha256(f"1:1{len(text.encode())}:{text}".encode()).hexdigest()

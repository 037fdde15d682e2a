"""Whole results of the queries without SQL against plain programmes, over all supplied documents."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from test_pii import slow as slow_spans
from test_simhash import slow_components, slow_fingerprint

from orderflow.llm import bpe, quality, unigram
from orderflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are absent")


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text or "") for r in rows]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def result(spark, name):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF_DIR).collect())


def test_op3_fingerprints_and_components(spark, documents):
    prints = {i: slow_fingerprint(t) for i, t in documents}
    groups = slow_components(sorted(prints.items()))
    assert result(spark, "op3_simhash") == sorted((i, f"{p:016x}", groups[i]) for i, p in prints.items())


def test_op4_ids_and_round_trip(spark, documents):
    ranks = bpe.Vocabulary.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for i, text in documents:
        ids = library.encode_ordinary(text)
        expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode())))
    assert result(spark, "op4_byte_bpe") == sorted(expected)


def test_op6_base_spans(spark, documents):
    expected = []
    for i, text in documents:
        spans = slow_spans(text)
        counts = [sum(s.startswith(kind + ":") for s in spans) for kind in ("email", "ip", "card", "phone")]
        expected.append((i, *counts, sha(",".join(spans).encode())))
    found = result(spark, "op6_pii")
    assert [row[:6] for row in found] == sorted(expected)
    for row, (_, text) in zip(found, sorted(documents), strict=True):
        spans = [s.split(":") for s in row[6].split(",") if s]
        kept = [":".join(s) for s in spans if s[0] in ("email", "ip", "card", "phone")]
        assert kept == slow_spans(text)
        assert all(0 <= int(a) < int(b) <= len(text) for _, a, b in spans)


def test_op7_scores(spark, documents):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    network = quality.train(docs, labels)
    found = result(spark, "op7_quality")
    assert [row[0] for row in found] == sorted(i for i, _ in documents)
    for (i, held, score, predicted), (_, text) in zip(found, sorted(documents), strict=True):
        assert held == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert abs(score - network.score([text.encode()])[0]) < 1e-6 and predicted == int(score >= 0.3)
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    scored = [(row[2], truth[row[0]]) for row in found if row[1] and row[0] in truth]
    good = [s for s, q in scored if q == 1]
    bad = [s for s, q in scored if q == 0]
    ranked = [(g > b) + (g == b) / 2 for g in good for b in bad]
    assert not ranked or np.mean(ranked) > 0.8


def test_op8_counts_and_scores(spark, documents):
    counter = unigram.TokenCounter(
        bpe.Vocabulary.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    )
    known = {}

    def plain(piece):
        data, best = piece.encode(), [(0, 0)]
        for end in range(1, len(data) + 1):
            starts = range(max(0, end - counter.longest), end)
            best.append(max(
                (best[s][0] + counter.scores[data[s:end]], best[s][1] - 1)
                for s in starts if data[s:end] in counter.scores
            ))
        return best[-1]

    expected = []
    for i, text in documents:
        score = count = 0
        for piece in regex.findall(public_tokenizers.PATTERN, text):
            if piece not in known:
                known[piece] = plain(piece)
            score += known[piece][0]
            count -= known[piece][1]
        expected.append((i, count, score))
    assert result(spark, "op8_token_counts") == sorted(expected)

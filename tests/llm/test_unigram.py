"""Token counts against a plain dynamic programme over each pre-token."""

import random

import public_tokenizers
import regex

from orderflow.llm import bpe, unigram

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def slow(counter, text):
    count = score = 0
    for piece in regex.findall(public_tokenizers.PATTERN, text or ""):
        data = piece.encode()
        best = [(0, 0)]
        for end in range(1, len(data) + 1):
            best.append(max(
                (best[s][0] + counter.scores[data[s:end]], best[s][1] - 1)
                for s in range(end) if data[s:end] in counter.scores
            ))
        score += best[-1][0]
        count -= best[-1][1]
    return count, score


def texts():
    rng = random.Random(6)
    out = ["", "the house", "don't  stop\n\n", "x" * 900, "é日本🙂" * 5]
    return out + ["".join(rng.choice("theing rsé ") for _ in range(60)) for _ in range(60)]


def test_equals_plain_programme(spark):
    ranks = bpe.Vocabulary.read_ranks(PATH)
    whole = unigram.TokenCounter(ranks, public_tokenizers.PATTERN)
    small = unigram.TokenCounter(ranks, public_tokenizers.PATTERN, max_nodes=40)
    for text in texts():
        expected = slow(whole, text)
        assert whole.text(text.encode()) == small.text(text.encode()) == expected
    docs = spark.createDataFrame(
        [(i, t, 0) for i, t in enumerate(texts())] + [(None, None, 1), (1, "the house", 2)],
        "doc_id int, text string, tokens int",
    )
    counted, name = unigram.count_tokens(docs, PATH, public_tokenizers.PATTERN, ["doc_id", "tokens", "text"])
    assert name == "tokens_"
    rows = counted.collect()
    assert len(rows) == len(texts()) + 2
    for row in rows:
        assert tuple(row[name]) == slow(whole, row.text)
    assert unigram.count_tokens(docs.where("doc_id = -1"), PATH, public_tokenizers.PATTERN, [])[0].collect() == []


def test_prefixes_are_scored_once(monkeypatch):
    counter = unigram.TokenCounter(bpe.Vocabulary.read_ranks(PATH), public_tokenizers.PATTERN)
    calls = []
    forward = counter._forward
    monkeypatch.setattr(counter, "_forward", lambda p, b: calls.append(p) or forward(p, b))
    counter.piece("station")
    counter.piece("stations")
    counter.piece("stationary")
    assert len(calls) == len(set(calls)) == len("station") + 1 + 3

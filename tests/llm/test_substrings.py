"""Substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np

from orderflow.llm import substrings


def slow(rows, window):
    split = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    order = [substrings.LAST if i is None else i for i, _ in split]
    starts = {}
    for sid, (_, words) in zip(order, split, strict=True):
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            starts[key] = min(sid, starts.get(key, sid))
    out = []
    for sid, (doc, words) in zip(order, split, strict=True):
        gone = set()
        for k in range(len(words) - window + 1):
            if starts[tuple(words[k : k + window])] < sid:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}é" for k in range(40)]

    def draw(n):
        return [rng.choice(words) for _ in range(n)]

    passages = [draw(n) for n in (12, 13, 14, 30, 60)]
    rows = [(None, None), (1, ""), (2, "  \n"), (3, "only few words"), (90, " ".join(passages[4]))]
    for i in range(10, 60):
        text = draw(rng.randrange(0, 50))
        for _ in range(rng.randrange(0, 3)):
            text += rng.choice(passages) + draw(rng.randrange(0, 9))
        rows.append((i, "  ".join(text) if i % 2 else "\n".join(text)))
    rows += [(rng.randrange(5, 99), rows[k][1]) for k in rng.sample(range(5, 55), 12)]
    near = rows[20][1].split() + draw(80)
    rows += [(200 + k, " ".join([*near[: 7 * k], "new", *near[7 * k + 1 :]])) for k in range(8)]
    rows += [(None, " ".join(near)), (None, " ".join(near)), (300, " ".join(["x"] * 60)), (301, " ".join(["x"] * 45))]
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark, monkeypatch):
    for seed in (1, 2):
        monkeypatch.setattr(substrings, "SHARD_WORDS", 20_000 if seed == 1 else 10)
        rows = corpus(seed)
        docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, sid int, spans string")
        found = substrings.repeated_passages(docs, window=13, gram=4).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str)
        assert got == slow(rows, 13)
        assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)
    assert substrings.repeated_passages(docs.where("doc_id = -1")).collect() == []


def test_automaton_matches_substrings():
    rng = random.Random(3)
    for _ in range(200):
        runs = [[rng.choice("ab") for _ in range(rng.randrange(1, 12))] for _ in range(2)]
        text = [rng.choice("ab") for _ in range(25)]
        covered = set()
        for run in runs:
            for k in range(len(run) - 2):
                for j in range(len(text) - 2):
                    if text[j : j + 3] == run[k : k + 3]:
                        covered.update(range(j, j + 3))
        spans = substrings.SuffixAutomaton(runs).spans(text, 3)
        assert {p for a, b in spans for p in range(a, b)} == covered


def test_shards_hold_every_window():
    runs = [[b"%d-%d" % (r, k) for k in range(n)] for r, n in enumerate((50, 5, 7, 31))]
    for size in (1, 6, 40, 1000):
        shards = list(substrings.shard_runs(runs, 5, size))
        held = {tuple(w[k : k + 5]) for s in shards for w in s for k in range(len(w) - 4)}
        assert held == {tuple(w[k : k + 5]) for w in runs for k in range(len(w) - 4)}
        assert max(sum(map(len, s)) for s in shards) <= size + 4


def test_hashes_of_chunks_and_windows(monkeypatch):
    joined = b" ".join(b"word%d" % (k % 50) for k in range(400)) + b" " + b"z" * 300
    whole = substrings.word_hashes(joined)
    assert len(whole) == 401 and len(set(whole.tolist())) == 51
    monkeypatch.setattr(substrings, "_CHUNK", 64)
    assert np.array_equal(substrings.word_hashes(joined), whole)
    for size in (1, 7, 10, 50):
        hashes = substrings.gram_hashes(whole, size)
        assert len(hashes) == 402 - size
        assert len(set(hashes.tolist())) == len({tuple(whole[i : i + size]) for i in range(402 - size)})
        assert substrings.sliding_min(whole, size).tolist() == [whole[i : i + size].min() for i in range(402 - size)]

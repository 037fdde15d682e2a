"""Benchmark decontamination against brute force."""

import random
import re

import numpy as np
import pytest

from orderflow.llm import decontaminate


def slow_words(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def slow(docs, items):
    out = []
    for doc_id, text in docs:
        words, hit, names = slow_words(text), set(), set()
        for item, body in items:
            item_words = slow_words(body)
            size = min(13, len(item_words))
            for i in range(len(item_words) - size + 1 if size else 0):
                window = item_words[i : i + size]
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == window:
                        hit.update(range(j, j + size))
                        if item is not None:
                            names.add(str(item))
        out.append((doc_id, len(words), sorted(hit), sorted(names)))
    return out


LONG = " ".join(f"Wört{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "two words"), (3, None), (4, "..."), (None, "solo"), (2, "two words"),
         (10, "two  WORDS!"), (11, " ".join(["x"] * 14))]
DOCS = [
    (1, None), (2, ""), (3, "!!"), (4, LONG), (5, "intro " + LONG + " end"),
    (6, " ".join(LONG.split()[:12])), (7, " ".join(LONG.split()[5:18])), (8, "TWO-words two\nwords"),
    (9, "atwo words wordsb"), (10, "solo"), (11, " ".join(["y"] * 400 + ["two", "words"])),
    (12, " ".join(["x"] * 20)), (None, "two words"), (4, LONG), (13, "é two,words ü"),
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(*d, "c") for d in DOCS], "doc_id long, text string, hits string")
    items = spark.createDataFrame([(*i, 0) for i in ITEMS], "item_id long, text string, n_hit int")
    scanned, hits = decontaminate.scan_documents(docs, items, ["doc_id", "hits", "text"])
    assert hits == "hits_"
    got = scanned.collect()
    for row, expected in zip(got, slow(DOCS, ITEMS), strict=True):
        found = row[hits]
        assert (row.doc_id, found.n_words, found.n_hit, found["items"]) == (
            expected[0], expected[1], len(expected[2]), expected[3])
        covered = [w for s in found.spans for w in slow_words(row.text[s.start : s.end])]
        assert covered == [slow_words(row.text)[k] for k in expected[2]]
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    bad = {d for d, n, hit, _ in slow(DOCS, ITEMS) if hit and 20 * len(hit) >= n}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in DOCS} - bad


def test_large_benchmarks_and_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none, name = decontaminate.scan_documents(docs, items.where("item_id > 99"), ["doc_id"])
    assert {r[name].n_hit for r in none.collect()} == {0}
    assert decontaminate.decontaminate(docs.where("doc_id > 99"), items).collect() == []
    with pytest.raises(ValueError, match="pass it in parts"):
        decontaminate.benchmark_items(items, "item_id", "text", limit=20)


def test_words_of_a_large_vocabulary_keep_their_symbols_apart():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(5000)]
    items = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 13, 40])))) for i in range(400)]
    automaton = decontaminate.Automaton([(i, text.encode()) for i, text in items])
    assert len(set(automaton.symbols.values())) == len(automaton.symbols)
    parts = [rng.choice(items)[1].split()[rng.randrange(9) :][: rng.randrange(30)] for _ in range(150)]
    others = [[rng.choice(vocabulary + ["unknown"]) for _ in range(5)] for _ in parts]
    text = " ".join(word for part, other in zip(parts, others, strict=True) for word in part + other)
    total, hit, found = automaton.scan(text.encode())
    ((_, words, expected, names),) = slow([(0, text)], items)
    assert (total, np.flatnonzero(hit).tolist(), sorted(found)) == (words, expected, names)
    assert 0 < len(expected) < words

"""Exact nearest codes against brute force."""

import numpy as np

from orderflow.llm import hamming


def slow(rows, queries, k):
    out = {}
    for qid, q in queries:
        if qid is None:
            continue
        near = sorted((((q ^ c) & (2**64 - 1)).bit_count(), i is None, i or 0) for i, c in rows if i != qid)
        out[qid] = [d for d, *_ in near[:k]]
    return out


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    codes = [(int(i), int(c)) for i, c in enumerate(base)]
    for i in range(40, 300):
        flip = sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 9), replace=False))
        codes.append((i, int(base[i % 40]) ^ flip))
    codes += [(7, codes[3][1]), (None, codes[5][1]), (None, codes[5][1])]
    frame = spark.createDataFrame([(*c, "x") for c in codes], "id long, code long, rank string").repartition(3)
    queries = frame.where("id % 10 = 0")
    expected = slow(codes, [c for c in codes if c[0] is not None and c[0] % 10 == 0], 5)
    by_id = {}
    for i, c in codes:
        by_id.setdefault(i, []).append(c)
    for block, part in ((hamming.QUERY_BLOCK, hamming.INDEX_ROWS), (7, 50)):
        monkeypatch.setattr(hamming, "QUERY_BLOCK", block)
        monkeypatch.setattr(hamming, "INDEX_ROWS", part)
        got = {}
        for r in hamming.nearest_codes(frame, queries, 5).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r)
        assert {q: [r.distance for r in rs] for q, rs in got.items()} == expected
        for q, rs in got.items():
            assert [r["rank"] for r in rs] == list(range(1, 6))
            keys = [(r.distance, r.neighbour_id is None, r.neighbour_id or 0) for r in rs]
            assert keys == sorted(keys)
            for r in rs:
                assert any(((a ^ by_id[q][0]) & (2**64 - 1)).bit_count() == r.distance for a in by_id[r.neighbour_id])


def test_few_rows_null_vectors_and_empty_tables(spark):
    rows = [(1, [1.0, -1.0]), (2, None), (3, [None, 1.0]), (4, []), (None, [1.0] * 70), (50, [1.0] * 64)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    codes = hamming.sign_codes(vectors, "vec_id", "embedding")
    got = {r.id: r.code for r in codes.collect()}
    assert got == {1: 1, 4: 0, None: -1, 50: -1}
    found = hamming.nearest_codes(codes, codes.where("id = 50"), 10).orderBy("rank").collect()
    assert [(r.neighbour_id, r.distance) for r in found] == [(None, 0), (1, 63), (4, 64)]
    assert hamming.nearest_codes(codes.where("id = 9"), codes, 3).collect() == []
    assert hamming.nearest_codes(codes, codes.where("id = 9"), 3).collect() == []

"""Codebooks and codes against plain integer k-means, and the bounds against exact distances."""

import random

import numpy as np
import pytest

from orderflow.llm import codebooks


def plain(rows, parts=8, entries=16, rounds=6):
    """rows of (id, vector): codes and errors in order of id and vector, and the final codebooks."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([v for _, v in kept], np.float64) * 4096).astype(np.int64)
    x = x.reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    for step in range(rounds + 1):
        codes, errors = [], np.zeros(len(kept), np.int64)
        for p in range(parts):
            far = ((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2)
            codes.append(far.argmin(axis=1))
            errors += far.min(axis=1)
        if step < rounds:
            for p in range(parts):
                for k in range(len(books[p])):
                    own = x[codes[p] == k, p]
                    if len(own):
                        books[p][k] = np.array([int(s) // len(own) for s in own.sum(axis=0)])
    found = sorted((str(i), bytes(int(c[n]) for c in codes).hex(), int(errors[n])) for n, (i, _) in enumerate(kept))
    return found, np.stack(books)


def vectors(n, seed, size=16, scale=0.5):
    rng = random.Random(seed)
    centres = [[rng.uniform(-scale, scale) for _ in range(size)] for _ in range(12)]
    return [(k, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for k in range(n)]


def run(spark, rows, kind="double", extra=("label", "code")):
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, coded string, label int")
    coded, name, books = codebooks.encode(frame.repartition(3), ["vec_id", "coded"])
    assert coded.columns == ["vec_id", "coded", "coded_"] and name == "coded_"
    return sorted((str(r.vec_id), bytes(r[name].code).hex(), r[name].error) for r in coded.collect()), books


@pytest.mark.parametrize("n", [400, 16, 5, 1])
def test_equals_plain_version(spark, n):
    rows = vectors(n, n)
    expected, books = plain(rows)
    got, found = run(spark, rows)
    assert got == expected and (found == books).all()


def test_nulls_ties_and_repeated_rows(spark):
    rng = random.Random(5)
    rows = [(k % 30, [rng.choice([-0.5, 0.0, 0.25, -0.0001]) for _ in range(8)]) for k in range(120)]
    rows += [(2, None), (3, [None] * 8), (4, [0.1] * 7 + [float("nan")]), (5, [float("inf")] * 8), (None, [0.3] * 8)]
    rows += [rows[0]] * 60
    expected, books = plain(rows)
    got, found = run(spark, rows)
    assert got == expected and (found == books).all()


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(1, None), (2, [float("nan")] * 8)]):
        got, books = run(spark, rows)
        assert got == [] and codebooks.text_of(books) == ""
    for rows, said in (
        ([(1, [0.1] * 8), (2, [0.1] * 16)], "equal parts"),
        ([(1, [0.1] * 9)], "equal parts"),
        ([(1, [])], "equal parts"),
        ([(1, [1e12] * 8)], "not supported"),
    ):
        with pytest.raises(ValueError, match=said):
            run(spark, rows)


def test_null_labels_form_one_group(spark):
    rows = [(k, [k / 50] * 8, None if k % 3 else k % 2) for k in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    coded, name, _ = codebooks.encode(frame, ["vec_id", "label"])
    sums = {r.label: r.label_error for r in codebooks.group_errors(coded, name, "label").collect()}
    expected = {}
    for row in coded.collect():
        expected[row.label] = expected.get(row.label, 0) + row[name].error
    assert sums == expected and None in sums


def test_bounds_hold_and_spare_rescans():
    x = np.floor(np.array([v for _, v in vectors(3000, 9, 16, 4.0)]) * 4096).astype(np.int64).reshape(3000, 2, 8)
    history = x[:16].swapaxes(0, 1)[None]
    state, rescans = codebooks.State.unknown(3000, 2), []
    for _ in range(7):
        before = state.rescanned
        state = codebooks.assign(x, state, history)
        rescans.append(state.rescanned - before)
        own, others = codebooks.displacements(history)
        for part in range(2):
            far = codebooks.squared_distances(x[:, part], history[-1][part])
            assert (state.code[:, part] == far.argmin(axis=1)).all()
            code = state.code[:, part]
            near = np.sqrt(far[np.arange(3000), code])
            assert (state.upper[:, part] + own[state.upper_round[:, part], part, code] >= near).all()
            far[np.arange(3000), code] = np.iinfo(np.int64).max
            lower = state.lower[:, part] - others[state.lower_round[:, part], part, code]
            assert (lower <= np.sqrt(far.min(axis=1))).all()
        history = np.concatenate([history, codebooks.refine(history[-1], codebooks.entry_totals(x, state.code, 16))[None]])
    assert rescans[0] == 6000 and min(rescans[3:]) < 2000
    assert len(np.unique(state.lower_round)) > 1


def test_net_displacement_is_tighter_than_summed_moves():
    there_and_back = np.array([[[[0, 0]]], [[[300, 400]]], [[[0, 0]]]])
    own, _ = codebooks.displacements(there_and_back)
    assert own[0, 0, 0] == 0 and 500 <= own[1, 0, 0] < 501

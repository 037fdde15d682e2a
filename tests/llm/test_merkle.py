"""Trees, proofs and folded roots against a plain recursive version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from orderflow.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf_of(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, fanout):
    """The root of a list of digests, and for every one of them its (left, right) on each level."""
    paths, places, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for path, place in zip(paths, places, strict=True):
            start = place // fanout * fanout
            path.append(("".join(level[start:place]), "".join(level[place + 1 : start + fanout])))
        places = [place // fanout for place in places]
        level = [sha(*level[k : k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], paths


def plain(rows, fanout):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = []
    for source in order:
        held = sorted(trees[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        built.append((held, *climb([leaf_of(r) for r in held], fanout)))
    root, above = climb([b[1] for b in built], fanout)
    out = []
    for (held, subroot, paths), upper in zip(built, above, strict=True):
        for row, path in zip(held, paths, strict=True):
            folded = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                folded = leaf_of([*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])])
            for left, right in path + upper:
                folded = sha(left, folded, right)
            proof = sha(*[left + right for left, right in path + upper])
            out.append((row[0], leaf_of(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def run(spark, rows, fanout):
    docs = spark.createDataFrame(
        [(*row, {"k": 1}, "x") for row in rows],
        "doc_id long, source string, lang string, n_chars int, text string, digest map<string,int>, tree string",
    ).repartition(6)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", merkle.UPPER, merkle.LOWER)
    changed = merkle.leaf(*[lowered if name == "text" else F.col(name) for name in COLUMNS])
    manifest = merkle.build(merkle.leaves(docs, COLUMNS, presented=F.when(tampered, changed)), fanout)
    proven = merkle.verify(merkle.proofs(manifest))
    got = proven.select(
        "leaf_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), "folded_root", "verified"
    )
    roots = [r.digest for r in manifest.root().collect()]
    return sorted((tuple(r) for r in got.collect()), key=str), roots


def rows_of(n, seed):
    rng = random.Random(seed)
    return [
        (k, rng.choice(["hot", "hot", "hot", "é", "z", "Z", "", "aa", "a", None]), rng.choice(["en", None]),
         rng.choice([None, -3, k]), rng.choice([None, "", f"Text {k}", "é日本🙂" * k, "lower"]))
        for k in range(n)
    ]


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_equals_plain_version(spark, fanout):
    rows = rows_of(230, fanout)
    rows += [(7, "hot", "en", 1, "Same"), (7, "hot", "en", 1, "Same"), (7, "hot", "en", 2, "Other"), (None, "hot", None, None, "A"),
             (None, None, None, None, None), (500, "lone", "en", 4, "B" * 200_000)]
    got, roots = run(spark, rows, fanout)
    expected = plain(rows, fanout)
    assert got == expected and roots == [expected[0][3]]
    assert {r[6] for r in got} == {True, False}


def test_a_hot_group_of_equal_rows_is_spread(spark):
    rows = [(1, "s", "en", 3, "Copy")] * 150 + rows_of(100, 1)
    got, _ = run(spark, rows, 16)
    assert got == plain(rows, 16)
    found = merkle.leaves(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string"), COLUMNS)
    numbered = merkle.number_rows(merkle.store(found, "t"), ["source_key", "leaf_id", "leaf"], "t")
    of_copy = [r["count"] for r in numbered.where("leaf_id = 1").groupBy("part").count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = merkle.number_rows(merkle.store(found, "t"), ["source_key", "leaf_id", "leaf"], "t")
        of_copy = [r["count"] for r in numbered.where("leaf_id = 1").groupBy("part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(of_copy) > 1 and max(of_copy) < 150


@pytest.mark.parametrize("rows", [[], [(3, "s", None, None, "One")], [(3, "s", None, None, "One"), (3, None, None, None, None)]])
def test_smallest_tables(spark, rows):
    got, roots = run(spark, rows, 16)
    if not rows:
        assert got == [] and roots == []
    else:
        assert got == plain(rows, 16)
        if len(rows) == 1:
            assert got[0][4] == sha() and roots == [got[0][1]]


def test_fields_of_different_split_differ(spark):
    rows = [("a", "bc", None), ("ab", "c", None), ("abc", "", None), ("abc", None, ""), ("abc", "-", None)]
    docs = spark.createDataFrame(rows, "a string, b string, c string")
    assert docs.select(merkle.leaf(F.col("a"), F.col("b"), F.col("c")).alias("l")).distinct().count() == 5

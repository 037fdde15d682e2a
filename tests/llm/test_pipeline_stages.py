"""The corpus pipeline on a small fixture, stage by stage."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as registry
import corpus_pipeline
from orderflow.llm import bpe, quality
from orderflow.sources import staging
from test_pii import slow as slow_spans
from test_simhash import slow_components, slow_fingerprint

original = staging.delete_folder
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def prose(rng, n):
    return " ".join(rng.choice(["the", "river", "and", "stone", "house", "with"], n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        text = prose(rng, 60)
        rows.append((i, " ".join(w.upper() + "!!" for w in text.split()) if i % 4 == 3 else text))
    for i in range(20):
        rows.append((400 + i, rows[4 * i][1]))  # exact copies
    rows += [(500, f"{prose(rng, 30)} {ITEM}"), (501, f"{prose(rng, 50)} me@mail.com"), (502, None), (None, "the house")]
    folder = tmp_path_factory.mktemp("sf")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = [(i, t, "en", None, len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 4 != 3), 0) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_take_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, tables)
        assert k == 4 or docs.columns == columns
        seen.append({r[0]: r for r in docs.collect()})
    good, single, clean, private, tokens = seen
    # Every stage's result is exactly what a plain version keeps.
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    network = quality.train(*(spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels")))
    scores = network.score([(t or "").encode() for _, t in rows])
    assert set(good) == {i for (i, _), score in zip(rows, scores, strict=True) if score >= 0.3}
    numbered = {k: slow_fingerprint(r.text) for k, r in enumerate(good.values())}
    ids = list(good)
    order = sorted(numbered, key=lambda k: (ids[k] is None, ids[k] or 0))
    place = {k: n for n, k in enumerate(order)}
    groups = slow_components(sorted((place[k], p) for k, p in numbered.items()))
    assert set(single) == {ids[order[n]] for n in set(groups.values())}
    assert all(single[i].text == good[i].text for i in single)
    hits = {i for i in single if ITEM in (single[i].text or "")}
    assert set(clean) == set(single) - hits
    masked = {i for i in clean if slow_spans(clean[i].text)}
    assert masked == {501} and all(private[i] == clean[i] for i in set(clean) - masked)
    assert not any(i in good for i in range(3, 300, 4)) and len(good) >= 225 + 20
    assert set(good) - set(single) >= set(range(400, 420))
    assert 0 in single and 500 in single and 500 not in clean
    assert set(single) - set(clean) == {500}
    assert private[501].text.endswith("[EMAIL]") and private[501].n_chars == len(private[501].text)
    assert set(tokens) == set(private) == set(clean)
    ranks = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for key, row in tokens.items():
        text = private[key].text or ""
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == library.encode_ordinary(text)
        assert row.n_tokens == len(row.ids) // 4 and row.text == text


def test_run_is_registered(spark, tables):
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    found = corpus_pipeline.run(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, docs.collect()))


def test_run_leaves_only_its_result(spark, tables, monkeypatch):
    from orderflow.llm import common

    kept = []
    monkeypatch.setattr(common, "delete_folder", lambda spark, path: kept.append(path) or original(spark, path))
    found = corpus_pipeline.run(spark, tables)
    names = [path.rpartition("/")[2] for path in kept]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert sum(n.startswith("pipeline-" + name.replace(" ", "-")) for n in names) == 1
    assert any(n.startswith("numbered") for n in names) and found.count() > 0


def test_empty_documents_and_odd_columns_go_through_all_stages(spark, tables, tmp_path):
    odd = ["map('a', doc_id) AS row", "struct(doc_id AS x) AS fp", "text AS quality", "doc_id AS hits"]
    docs = spark.read.parquet(f"{tables}/documents.parquet").selectExpr("*", *odd)
    for rows in (docs, docs.where("doc_id < -1")):
        found = rows
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            found = stage(spark, found, tables)
            assert k == 4 or found.columns == docs.columns
        assert found.columns == ["doc_id", "n_tokens", "ids", "text"]
        assert (found.count() > 0) == (rows is docs)
    folder = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(folder)).collect() == []


def test_near_copies_are_decided_by_row(spark):
    rng = np.random.default_rng(5)
    a, b, c, d, e = (" ".join(f"w{k}" for k in rng.integers(0, 10**6, 40)) for _ in range(5))
    rows = [(3, a), (7, a), (7, b), (8, c), (8, c), (8, c), (None, a), (None, d), (None, d), (9, e), (None, e)]
    rows += [(5, None), (6, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string").repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(3, a), (7, b), (8, c), (None, d), (9, e), (5, None)], key=repr)

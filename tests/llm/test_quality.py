"""The quality network: gradients, training on made-up texts, covering of whole texts."""

import zlib

import numpy as np

from orderflow.llm import quality


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    good = ["the", "house", "and", "river", "with", "stone"]
    out = []
    for i in range(n):
        words = [good[k] for k in rng.integers(0, 6, rng.integers(5, 300))]
        bad = i % 3 == 0
        out.append((i, " ".join(w.upper() + "!!" if bad else w for w in words), int(not bad)))
    return out


def test_learns_and_scores_every_row(spark):
    rows = corpus(240)
    docs = spark.createDataFrame(
        [(i, t, 1.5) for i, t, _ in rows] + [(None, None, 0.1), (900, "", 0.2), (3, rows[3][1], None)],
        "doc_id long, text string, quality double",
    )
    labels = spark.createDataFrame(
        [(i, q, 0) for i, _, q in rows] + [(5, None, 1), (None, 1, 1), (7777, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    network = quality.train(docs, labels, rows=150)
    scored, name = quality.score_documents(docs, network, ["doc_id", "quality"])
    assert name == "quality_"
    got = scored.collect()
    assert len(got) == 243 and all(0 <= r[name].score <= 1 for r in got)
    by_id = {r.doc_id: r[name].score for r in got}
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(by_id[i] >= 0.3) == q for i, q in held]) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 140 < kept.count() < 200
    assert quality.keep_good(docs.where("doc_id < 0"), labels).collect() == []
    flags = docs.select("doc_id", quality.held_out("doc_id").alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in flags)


def test_maxima_cover_the_whole_text_whatever_its_neighbours():
    network = quality.fit([t.encode() for _, t, _ in corpus(30)], np.array([q for *_, q in corpus(30)]), 20)
    taps = network.taps()
    texts = [b"", b"a", b"xyz" * 400, bytes(range(256)) * 60, b"q" * 256, b"end of it"]
    together = network.score(texts)
    for text, score in zip(texts, together, strict=True):
        assert np.isclose(network.score([text])[0], score)
        data = np.frombuffer(text + bytes(quality.WIDTH), np.uint8)
        n = max(1, len(text))
        conv = sum(taps[k][data[k : k + n]] for k in range(quality.WIDTH))
        blocks = [conv[i : i + 256].max(axis=0) for i in range(0, n, 256)]
        chunks = [np.max(blocks[i : i + 4], axis=0) for i in range(0, max(1, len(blocks) - 2), 2)]
        pooled = np.maximum(np.array(chunks) + network.bias, 0)
        logit = np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)]) @ network.weights
        assert np.isclose(1 / (1 + np.exp(-(logit + network.offset[0]))), score, atol=1e-5)


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    network = quality.Network(1)
    network.weights[:] = rng.normal(0, 1, len(network.weights))
    for parameter in network.parameters():
        parameter += 0.0
    texts, labels = [b"some text " * 90, b"OTHER!!" * 300, b""], np.array([1.0, 0.0, 1.0])

    def loss():
        network.__dict__.pop("pairs", None)
        p = network.score(texts)
        ridge = 0.5e-4 * float((network.weights**2).sum())
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)) + ridge

    grads = network.gradients(texts, labels)
    for parameter, grad in zip(network.parameters(), grads, strict=True):
        flat, slope = parameter.reshape(-1), np.asarray(grad).reshape(-1)
        for at in np.argsort(-np.abs(slope))[:3]:
            old = flat[at]
            flat[at] = old + 1e-2
            up = loss()
            flat[at] = old - 1e-2
            down = loss()
            flat[at] = old
            assert np.isclose((up - down) / 2e-2, slope[at], rtol=0.15, atol=2e-4)


def test_long_texts_train_by_an_excerpt(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_BYTES", 600)
    rows = corpus(120)
    # Every bad text is too long to be taken whole.
    docs = spark.createDataFrame(
        [(i, text if good else text * 40) for i, text, good in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, good) for i, _, good in rows], "doc_id long, quality int")
    seen = {}

    def fit(texts, labels, follow=quality.fit):
        seen.update(texts=texts, labels=labels)
        return follow(texts, labels, 150)

    monkeypatch.setattr(quality, "fit", fit)
    network = quality.train(docs, labels)
    assert set(seen["labels"]) == {0.0, 1.0} and max(map(len, seen["texts"])) == 600
    whole = {text.encode() for _, text, _ in rows}
    for text, label in zip(seen["texts"], seen["labels"], strict=True):
        assert any(text in (w if label else w * 40) for w in whole)
    scores = network.score([t.encode() for _, t, _ in rows])
    ranked = sorted(zip(scores, (good for *_, good in rows), strict=True))
    assert sum(good for _, good in ranked[-40:]) > 36

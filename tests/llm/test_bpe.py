"""Byte-level BPE against the tiktoken library and the round trip."""

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

from orderflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def texts(tokens):
    rng = random.Random(11)
    some = ["", " ", "\n\n x", "don't we'll", "<|endoftext|>", "a" * 300, " " * 99, "ab" * 77, "日本語🙂é"]
    some += ["".join(rng.choice("abc é\n0'🙂.") for _ in range(rng.randrange(50))) for _ in range(200)]
    some += ["".join(rng.choice(tokens).decode("utf8", "ignore") for _ in range(9)) for _ in range(400)]
    return some


@pytest.mark.parametrize("max_states", [0, 50, bpe.MAX_STATES])
def test_ids_equal_the_library(vocabulary, library, max_states, monkeypatch):
    monkeypatch.setattr(bpe, "COMMIT", 7 if max_states == 50 else 256)
    encoder, decoder = bpe.Encoder(vocabulary, public_tokenizers.PATTERN), bpe.Decoder(vocabulary.tokens)
    encoder.transducer.max_states = max_states
    monkeypatch.setattr(bpe, "MAX_PIECES", 20)
    monkeypatch.setattr(bpe, "LONG_TEXT", 200)
    for text in texts(list(vocabulary.tokens.values())):
        ids = encoder.encode(text.encode())
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text
        assert decoder.decode(ids, 3) == text


def test_classes_exclude_the_followers_that_merges_cross(vocabulary):
    rng = random.Random(5)
    machine = bpe.Transducer(vocabulary)
    made = [rank for rank in vocabulary.tokens if rank < 256 or rank in vocabulary.parts]
    excluded = 0
    for _ in range(3000):
        left, right = rng.choice(made), rng.choice(made[:3000])
        # A token that starts like a known neighbour is more often excluded than a random one.
        if rng.random() < 0.6 and vocabulary.threats(left):
            right = rng.choice(vocabulary.threats(left))[0]
            while vocabulary.grown.get(right) and rng.random() < 0.6:
                right = rng.choice(vocabulary.grown[right])
        first = vocabulary.tokens[right][0]
        node, mask = machine._open(machine._class(left), first)
        place = vocabulary.place[right] - vocabulary.low[node]
        fits = vocabulary.compatible(left, right)
        assert mask >> place & 1 == (not fits), (left, right)
        excluded += not fits
    assert 500 < excluded < 2500


def test_documents_go_through_few_states(vocabulary, library):
    """All pieces that are not one token are read by states, whose number levels off."""
    machine = bpe.Transducer(vocabulary)
    pattern = bpe.regex.compile(public_tokenizers.PATTERN)
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["text"])
    pieces = {p.encode() for text in table["text"].to_pylist() if text for p in pattern.findall(text)}
    several = sorted(p for p in pieces if p not in vocabulary.ranks)
    random.Random(3).shuffle(several)
    read = [0]

    def step(state, byte, follow=machine.step):
        read[0] += 1
        return follow(state, byte)

    machine.step = step
    half = len(several) // 2
    for part, most in ((several[:half], 8000), (several[half:], 2500)):
        before = machine.built
        for piece in part:
            assert machine.encode(piece) == library._core_bpe.encode_single_piece(piece)
        assert machine.built - before < most
    assert len(several) > 10_000 and len(machine.states) == machine.built
    done = read[0]  # what was read once needs no new step
    for piece in several:
        machine.encode(piece)
    assert read[0] == done


def test_long_pieces_emit_before_their_end(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "COMMIT", 16)
    machine = bpe.Transducer(vocabulary)
    held = []

    def settle(state, ends, follow=machine._settle):
        agreed, rest = follow(state, ends)
        held.append(len(rest))
        return agreed, rest

    machine._settle = settle
    piece = b"antidisestablishmentarianism" * 400
    assert b"".join(vocabulary.tokens[t] for t in machine.encode(piece)) == piece
    assert len(held) == (len(piece) - 1) // 16 and max(held) < 64


def test_decoder_equals_python_on_any_bytes(vocabulary):
    single = {token[0]: rank for rank, token in vocabulary.tokens.items() if len(token) == 1}
    rng = random.Random(2)
    pool = [0x41, 0x80, 0xBF, 0xC2, 0xC0, 0xE0, 0xED, 0xA0, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xF5, 0xE2]
    for _ in range(3000):
        data = bytes(rng.choice(pool) for _ in range(rng.randrange(9)))
        decoder = bpe.Decoder.__new__(bpe.Decoder)
        decoder.tokens, decoder.whole, decoder.states = vocabulary.tokens, {}, {}
        decoder.start = decoder.current = decoder.state(b"")
        text = "".join(decoder.push([single[b]]) for b in data) + decoder.finish()
        assert text == data.decode("utf-8", "replace")


def test_round_trip_on_a_table(spark, library):
    rows = [(1, "Hello é world"), (None, None), (2, ""), (1, "Hello é world"), (3, "x " * 4000)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, encoded string")
    done, ids, back = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN, ["doc_id", "encoded"])
    assert ids == "encoded_"
    for row, (doc_id, text) in zip(done.collect(), rows, strict=True):
        assert row.doc_id == doc_id and row[back] == (text or "")
        assert np.frombuffer(bytes(row[ids]), "<u4").tolist() == library.encode_ordinary(text or "")
    empty = bpe.round_trip(docs.where("doc_id = 9"), PATH, public_tokenizers.PATTERN, ["doc_id"])
    assert empty[0].collect() == []

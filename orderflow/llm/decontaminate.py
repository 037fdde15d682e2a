"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark windows.

Texts are reduced to lower-case words, and these to two symbols each: the number of the word among the
benchmark's words, written in two digits that share no symbol (other words are one symbol twice). The
automaton holds every window of 13 words of every benchmark item (the whole item if it is shorter) in
these symbols; it reads each document once. The ends of its matches are word numbers and, for
``spans``, mapped to positions in the original text. Very long texts are read whole; there are no ties.

Null and blank texts have no words: such documents are clean, such items have no window. Repeated
items count once per id; an item without an id marks words but is not listed. Extra columns are
ignored, or pass through in ``decontaminate``.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterable

import ahocorasick
import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from orderflow.llm.common import scan_texts

WINDOW = 13
# The benchmark's texts are broadcast, and each Python worker builds one automaton of all of them, which
# takes some 150 bytes of memory for each byte of text. Larger benchmarks are refused.
BENCHMARK_BYTES = 8 << 20
CONTAMINATED_SHARE = 20  # contaminated when at least one word in twenty is hit
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TABLE = bytes(
    byte if byte in _WORD_BYTES else 0x20 for byte in bytes(range(256)).lower()
)
_WORD = re.compile(rb"[^ ]+")
SCAN_SCHEMA = (
    "n_words long, n_hit long, items array<string>, "
    "spans array<struct<start:int,end:int>>"
)
_automata: dict[str, "Automaton"] = {}


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> Iterable[list[bytes]]:
    if not words:
        return
    for first in range(max(1, len(words) - size + 1)):
        yield words[first : first + size]


class Automaton:
    """The windows of (item id, text), and the symbols of their words."""

    _OTHER = "\0\0"

    def __init__(self, items: Iterable[tuple[str | None, bytes]], size: int = WINDOW):
        texts = [(item, words_of(text)) for item, text in items]
        vocabulary = sorted({word for _, words in texts for word in words})
        base = math.isqrt(len(vocabulary)) + 1
        self.symbols = {
            word: chr(1 + base + number // base) + chr(1 + number % base)
            for number, word in enumerate(vocabulary)
        }
        self.windows = ahocorasick.Automaton()
        # Windows of one length and the same items share what they stand for.
        meanings: dict[tuple[int, tuple[str, ...]], tuple[int, tuple[str, ...]]] = {}
        for item, words in texts:
            owner = () if item is None else (item,)
            for window in windows_of(words, size):
                key = self.encode(window)
                known = self.windows.get(key, None)
                if known is None:
                    meaning = (len(window), owner)
                elif set(owner) <= set(known[1]):
                    continue
                else:
                    meaning = (len(window), known[1] + owner)
                self.windows.add_word(key, meanings.setdefault(meaning, meaning))
        if len(self.windows):
            self.windows.make_automaton()

    def encode(self, words: list[bytes]) -> str:
        return "".join([self.symbols.get(word, self._OTHER) for word in words])

    def scan(self, text: bytes | None) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, marks of the hit words (empty if none is) and ids of the occurring items."""
        words = words_of(text)
        found: list[tuple[int, tuple]] = []
        if words and len(self.windows):
            found = list(self.windows.iter(self.encode(words)))
        if not found:
            return len(words), np.zeros(0, dtype=bool), set()
        last = np.array([end + 1 for end, _ in found]) // 2
        lengths = np.array([length for _, (length, _) in found])
        steps = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(steps, last - lengths, 1)
        np.add.at(steps, last, -1)
        items = {item for meaning in {m for _, m in found} for item in meaning[1]}
        return len(words), np.cumsum(steps[:-1]) > 0, items


def original_spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code-point positions in the original text."""
    bounds = np.array([m.span() for m in _WORD.finditer(text.translate(_TABLE))])
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    data = np.frombuffer(text, dtype=np.uint8)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return [
        {"start": int(points[bounds[first][0]]), "end": int(points[bounds[stop - 1][1]])}
        for first, stop in zip(edges[::2], edges[1::2], strict=True)
    ]


def _shared_automaton(key: str, items: Broadcast, size: int) -> Automaton:
    if key not in _automata:
        _automata.clear()
        _automata[key] = Automaton(items.value, size)
    return _automata[key]


def benchmark_items(
    benchmark: DataFrame, item_col: str, text_col: str, limit: int = BENCHMARK_BYTES
) -> list[tuple[str | None, bytes]]:
    """The benchmark's ids and texts (a small, given table, whose size is checked first)."""
    size = benchmark.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    if size > limit:
        raise ValueError(f"a benchmark of {size} bytes exceeds {limit}; pass it in parts")
    rows = benchmark.select(
        F.col(item_col).cast("string"), F.col(text_col).cast("string").cast("binary")
    ).where(F.col(text_col).isNotNull())
    return [(item, bytes(text)) for item, text in rows.collect()]


def scan_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: Iterable[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> tuple[DataFrame, str]:
    """``keep`` and a struct of n_words, n_hit, items and spans for every document.

    Returns the frame and the struct's name. The automaton is built once in each Python worker from
    a broadcast list of texts.
    """
    spark = docs.sparkSession
    items = spark.sparkContext.broadcast(benchmark_items(benchmark, item_col, item_text_col))
    key = uuid.uuid4().hex

    def scan(texts: list[bytes | None]) -> list:
        automaton = _shared_automaton(key, items, window)
        totals, hits, found = zip(*map(automaton.scan, texts), strict=True) if texts else ((),) * 3
        return [
            list(totals),
            [int(hit.sum()) for hit in hits],
            [sorted(ids) for ids in found],
            [original_spans(text, hit) if len(hit) else [] for text, hit in zip(texts, hits, strict=True)],
        ]

    return scan_texts(docs, text_col, keep, scan, SCAN_SCHEMA, "hits")


def contaminated(hits: str):
    """Condition on the struct: at least one hit word in every twenty."""
    n_hit, n_words = F.col(f"{hits}.n_hit"), F.col(f"{hits}.n_words")
    return (n_hit > 0) & (n_hit * CONTAMINATED_SHARE >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that are not contaminated."""
    scanned, hits = scan_documents(docs, benchmark, docs.columns, text_col)
    return scanned.where(~contaminated(hits)).select(*docs.columns)


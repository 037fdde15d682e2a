"""Token counts under a unigram vocabulary, with forward scores shared by a trie of pre-tokens.

The distinct pre-tokens of a batch of texts are inserted in a trie. Walking the trie computes, for
each prefix once, the best score and the fewest tokens of any segmentation of it into vocabulary
tokens; pre-tokens with a common prefix share all of that prefix's work. The values at a pre-token's
end are its token count and its score. A new node's score comes from one walk of the reversed vocabulary
from its end. A worker keeps the trie between batches and starts a new one when it holds MAX_NODES nodes;
counts of the pre-tokens seen since the start before that are kept, and no result depends on it.

The vocabulary is a public rank file; ranks follow frequency, so the token of rank r scores
-log(r + 2) (Zipf's law). Of segmentations with equal scores the one with fewer tokens counts. All
single bytes are tokens, so every text can be segmented. Null and empty texts have no token. Every row gives
one row, repeated rows and ids included; an empty table gives an empty one. Very long texts are cut into
pre-tokens one by one, and a pre-token of any length is scored with the values of its last bytes only.
Columns other than the text pass through if they are kept; the result's name avoids theirs.
"""

from __future__ import annotations

import math

import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from orderflow.llm.bpe import Vocabulary, ship_file
from orderflow.llm.common import scan_texts

MAX_NODES = 500_000
LONG_PIECE = 512  # bytes; longer pre-tokens are scored without being kept
LONG_TEXT = 1 << 20
# A score and a token count in one integer that orders by score, then by fewer tokens.
UNIT = 1 << 40


class TokenCounter:
    """Counts and scores of pre-tokens, with one forward pass for each distinct prefix."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_nodes: int = MAX_NODES):
        self.pattern = regex.compile(pattern)
        self.max_nodes = max_nodes
        # Integers, so that sums do not depend on their order: millionths of the natural logarithm.
        self.scores = {t: round(-1e6 * math.log(r + 2)) for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self._reverse_vocabulary()
        self.terminal: dict[str, tuple[int, int]] = {}
        self._reset()

    def _reverse_vocabulary(self) -> None:
        """A trie of the tokens read backwards: steps by (state, byte), and each state's token value."""
        self.steps: dict[int, int] = {}
        self.values: list[int | None] = [None]
        for token, score in self.scores.items():
            state = 0
            for byte in reversed(token):
                after = self.steps.get(state << 8 | byte)
                if after is None:
                    after = self.steps[state << 8 | byte] = len(self.values)
                    self.values.append(None)
                state = after
            self.values[state] = score * UNIT - 1

    def _reset(self) -> None:
        """A new trie; what is known of pre-tokens lasts one generation longer."""
        self.older, self.terminal = self.terminal, {}
        self.children: dict[int, int] = {}
        self.best: list[int] = [0]

    def _forward(self, prefix: bytes, before: list[int]) -> int:
        """The best value of a prefix, given those of all its shorter prefixes.

        Walks the reversed vocabulary from the prefix's end, so it stops after the longest match.
        """
        steps, values, state, best = self.steps, self.values, 0, None
        for start in range(len(prefix) - 1, -1, -1):
            state = steps.get(state << 8 | prefix[start])
            if state is None:
                break
            token = values[state]
            if token is not None:
                value = before[start] + token
                if best is None or value > best:
                    best = value
        return best

    def _long(self, data: bytes) -> int:
        """The value of a long pre-token, with values of the last bytes only."""
        path = [0]
        for end in range(1, len(data) + 1):
            window = data[max(0, end - self.longest) : end]
            path = path[-self.longest :]
            path.append(self._forward(window, path[-len(window) :]))
        return path[-1]

    def piece(self, text: str) -> tuple[int, int]:
        """Token count and score of one pre-token."""
        known = self.terminal.get(text)
        if known is not None:
            return known
        known = self.older.get(text)
        if known is None:
            data = text.encode()
            if len(data) > LONG_PIECE:
                return self._split(self._long(data))
            known = self._split(self._insert(data))
        if len(self.terminal) >= self.max_nodes:
            self._reset()
        self.terminal[text] = known
        return known

    @staticmethod
    def _split(value: int) -> tuple[int, int]:
        score = -(-value // UNIT)
        return score * UNIT - value, score

    def _insert(self, data: bytes) -> int:
        if len(self.best) + len(data) > self.max_nodes:
            self._reset()
        children, best, node, path = self.children, self.best, 0, [0]
        for end, byte in enumerate(data, 1):
            after = children.get(node << 8 | byte)
            if after is None:
                after = children[node << 8 | byte] = len(best)
                best.append(self._forward(data[:end], path))
            path.append(best[after])
            node = after
        return path[-1]

    def text(self, data: bytes | None) -> tuple[int, int]:
        """Token count and score of a whole text."""
        if not data:
            return 0, 0
        text = data.decode("utf-8", "replace")
        if len(text) <= LONG_TEXT:
            pieces = self.pattern.findall(text)
        else:
            pieces = (match.group() for match in self.pattern.finditer(text))
        count = score = 0
        for piece in pieces:
            tokens, value = self.terminal.get(piece) or self.piece(piece)
            count += tokens
            score += value
        return count, score


_counters: dict[tuple[str, str], TokenCounter] = {}


def _counter(name: str, pattern: str) -> TokenCounter:
    if (name, pattern) not in _counters:
        ranks = Vocabulary.read_ranks(SparkFiles.get(name))
        _counters[name, pattern] = TokenCounter(ranks, pattern)
    return _counters[name, pattern]


def count_tokens(
    docs: DataFrame, ranks_path: str, pattern: str, keep: list[str], text_col: str = "text"
) -> tuple[DataFrame, str]:
    """``keep`` and a struct of n_tokens and score (millionths); the frame and the struct's name."""
    name = ship_file(docs, ranks_path)

    def scan(texts: list[bytes | None]) -> list:
        counter = _counter(name, pattern)
        values = [counter.text(text) for text in texts]
        return [[v[0] for v in values], [v[1] for v in values]]

    return scan_texts(docs, text_col, keep, scan, "n_tokens long, score long", "tokens")

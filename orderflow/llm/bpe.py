"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by a UTF-8 state machine.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly if each two neighbours are
compatible: no merge across their border comes before the merges that made them. Reading a piece
byte by byte, the open readings are tokens in progress (nodes of the vocabulary's trie); at every byte
exactly one of them ends in a token compatible with the token before it. A state of the deterministic
transducer is the set of open readings, each with the tokens below its node that the token before it
excludes, and the class of the token that ended last: tokens which exclude the same followers share
states, and readings that can no longer end are dropped. States are built when first reached. All pieces that are not
one token go through them; where MAX_STATES are held, they are forgotten and built anew as they are met. A step
names the token that ends with its byte; of those, the tokens that all open readings agree on are
emitted every COMMIT bytes, and the rest at the piece's end.

Decoding. A state is the unfinished bytes of a character (at most three). The step for each state and
token, a text and the next state, is built when first used; malformed bytes become U+FFFD.

Null texts are encoded like empty ones, as no token; null ids decode to an empty text. Ids outside the
vocabulary are an error. Other columns pass through when kept.
"""

from __future__ import annotations

import base64
import sys
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from itertools import islice

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from orderflow.llm.common import free_name, scan_texts

MAX_STATES = 100_000
MAX_PIECES = 150_000  # encodings of pieces in each of a worker's two generations of them
COMMIT = 256  # bytes after which a piece emits what its open readings agree on
MAX_CLASHES = 200_000  # answers about a class of tokens and the first byte of the next
LONG_TEXT = 1 << 20  # characters; longer texts are split into pieces as they are read
LONG_PIECE = 256  # characters; longer pieces are not kept
_NONE = 1 << 62
_UINT32 = next(code for code in "IL" if array(code).itemsize == 4)
if sys.byteorder != "little":
    raise ImportError("ids are packed in the machine's byte order, which must be little-endian")


class Vocabulary:
    """Ranks of tokens with the merge that makes each, and a trie of their bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        singles = [rank for token, rank in ranks.items() if len(token) == 1]
        if len(singles) != 256 or max(singles) != 255:
            raise ValueError("the 256 single bytes must have the first ranks")
        # By rank: the two tokens whose merge makes it. Tokens no merge makes have none; they only
        # stand for a whole piece.
        self.parts: dict[int, tuple[int, int]] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.at: list[int] = [-1]
        self.depth: list[int] = [0]
        for rank in sorted(self.tokens):
            token = self.tokens[rank]
            if len(token) > 1:
                pair = self._find_parts(token, rank)
                if pair is None:
                    continue
                self.parts[rank] = pair
            self._insert(token, rank)
        self._number()

    @staticmethod
    def read_ranks(path: str) -> dict[bytes, int]:
        """Read a file of lines with a token in base 64 and its rank."""
        ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        return ranks

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return cls(cls.read_ranks(path))

    def _find_parts(self, token: bytes, rank: int) -> tuple[int, int] | None:
        for cut in range(1, len(token)):
            left, right = self.ranks.get(token[:cut], _NONE), self.ranks.get(token[cut:], _NONE)
            made = all(part < 256 or part in self.parts for part in (left, right))
            if made and left < rank and right < rank and self.compatible(left, right, rank):
                return left, right
        return None

    def _insert(self, token: bytes, rank: int) -> None:
        node = 0
        for byte in token:
            after = self.trie[node].get(byte)
            if after is None:
                after = self.trie[node][byte] = len(self.trie)
                self.trie.append({})
                self.at.append(-1)
                self.depth.append(self.depth[node] + 1)
            node = after
        self.at[node] = rank

    def compatible(self, left: int, right: int, limit: int = _NONE) -> bool:
        """Whether no merge of rank below ``limit`` joins the two where they meet.

        Undoes the merges at the border, latest first. Equal ranks are applied from left to right, so
        the right side's are undone first and lose against one across the border.
        """
        ranks, tokens, parts = self.ranks, self.tokens, self.parts
        while True:
            if ranks.get(tokens[left] + tokens[right], _NONE) < limit:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:
                limit, left = left, parts[left][1]
            else:
                limit, right = right + 1, parts[right][0]

    def _number(self) -> None:
        """Number the tokens in byte order, so that those below a node are consecutive."""
        self.low, self.size = [0] * len(self.trie), [0] * len(self.trie)
        self.place: dict[int, int] = {}
        stack = [(0, False)]
        while stack:
            node, done = stack.pop()
            if done:
                self.size[node] = len(self.place) - self.low[node]
                continue
            self.low[node] = len(self.place)
            if self.at[node] >= 0:
                self.place[self.at[node]] = len(self.place)
            stack.append((node, True))
            stack.extend((self.trie[node][byte], False) for byte in sorted(self.trie[node], reverse=True))
        self.length = {rank: len(token) for rank, token in self.tokens.items()}
        self.ordered = sorted(self.ranks)
        # By rank: the tokens whose merge has it on the left, in order of rank.
        self.grown: dict[int, list[int]] = {}
        for rank, (left, _) in self.parts.items():
            self.grown.setdefault(left, []).append(rank)
        self.joins: dict[int, list[tuple[int, int]]] = {}
        self.masks: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}  # one object for each threat

    def _joins(self, left: int) -> list[tuple[int, int]]:
        """(right, rank) of all tokens that are this one and another."""
        found = self.joins.get(left)
        if found is None:
            found = self.joins[left] = []
            start = self.tokens[left]
            for token in islice(self.ordered, bisect_right(self.ordered, start), None):
                if not token.startswith(start):
                    break
                right = self.ranks.get(token[len(start) :], _NONE)
                if right < 256 or right in self.parts:
                    found.append((right, self.ranks[token]))
        return found

    def threats(self, token: int) -> tuple[tuple[int, int], ...]:
        """(right, limit): a token made from ``right`` by merges of which the first has no rank below
        ``limit``, or ``right`` itself, cannot follow, since a merge across the border comes first.
        """
        found: dict[int, int] = {}
        undone = _NONE  # rank of the last merge undone at this token's end
        while True:
            for right, rank in self._joins(token):
                if rank < undone and right < undone:
                    found[right] = min(found.get(right, _NONE), max(rank, token))
            if token < 256:
                break
            undone, token = token, self.parts[token][1]
        # The next rank that occurs says the same, and makes more tokens' threats equal.
        threats = []
        for right in sorted(found):
            made = self.grown.get(right, [])
            at = bisect_left(made, found[right])
            pair = (right, made[at] if at < len(made) else _NONE)
            threats.append(self.pairs.setdefault(pair, pair))
        return tuple(threats)

    def beaten(self, token: int, limit: int) -> int:
        """The tokens that one of ``threats`` excludes: bits by place below the node of its first byte."""
        mask = self.masks.get((token, limit))
        if mask is None:
            base = self.low[self.trie[0][self.tokens[token][0]]]
            mask = 1 << (self.place[token] - base)
            made = self.grown.get(token, [])
            rest = made[bisect_left(made, limit) :]
            while rest:
                grown = rest.pop()
                mask |= 1 << (self.place[grown] - base)
                rest.extend(self.grown.get(grown, ()))
            self.masks[token, limit] = mask
        return mask


class _State(dict):
    """Byte to (next state, token that ends with this byte), for one set of open readings."""

    __slots__ = ("transducer", "readings", "last")

    def __init__(self, transducer: Transducer, readings: tuple, last: int):
        super().__init__()
        self.transducer, self.readings, self.last = transducer, readings, last

    def __missing__(self, byte: int) -> tuple[_State, int]:
        step = self[byte] = self.transducer.step(self, byte)
        return step


class Transducer:
    """Pieces to tokens, one byte at a time."""

    def __init__(self, vocabulary: Vocabulary, max_states: int = MAX_STATES):
        self.vocabulary = vocabulary
        self.max_states = max_states
        self.states: dict[tuple, _State] = {}
        self.built = 0  # states built so far, those forgotten included
        # Classes of last tokens: what threatens the token after (see Vocabulary.threats).
        self.classes: dict[tuple, int] = {(): 0}
        self.threats: list[tuple] = [()]
        self.class_of: dict[int, int] = {}
        self.clashes: dict[tuple[int, int], int] = {}
        self.start = self._state((), 0)

    def _state(self, readings: tuple, last: int) -> _State:
        state = self.states.get((readings, last))
        if state is None:
            if len(self.states) >= self.max_states:
                self.states.clear()
            state = self.states[readings, last] = _State(self, readings, last)
            self.built += 1
        return state

    def _class(self, token: int) -> int:
        found = self.class_of.get(token)
        if found is None:
            threats = self.vocabulary.threats(token)
            found = self.classes.setdefault(threats, len(self.threats))
            if found == len(self.threats):
                self.threats.append(threats)
            self.class_of[token] = found
        return found

    def _open(self, last: int, byte: int) -> tuple[int, int]:
        """The node after a token's first byte, and which tokens below it the class excludes."""
        node = self.vocabulary.trie[0][byte]
        clash = self.clashes.get((last, byte))
        if clash is None:
            clash = 0
            for token, limit in self.threats[last]:
                if self.vocabulary.tokens[token][0] == byte:
                    clash |= self.vocabulary.beaten(token, limit)
            if len(self.clashes) >= MAX_CLASHES:
                self.clashes.clear()
            self.clashes[last, byte] = clash
        return node, clash

    def step(self, state: _State, byte: int) -> tuple[_State, int]:
        vocabulary = self.vocabulary
        trie, at, low, size = vocabulary.trie, vocabulary.at, vocabulary.low, vocabulary.size
        following, ended = [], -1
        moved = []
        for node, clash in state.readings:
            after = trie[node].get(byte)
            if after is not None:
                clash = clash >> (low[after] - low[node]) & ((1 << size[after]) - 1)
                moved.append((after, clash))
        moved.append(self._open(state.last, byte))
        for node, clash in moved:
            if at[node] >= 0:
                if ended < 0 and not clash & 1:
                    ended = at[node]
                clash |= 1  # has ended or never will
            if clash != (1 << size[node]) - 1:
                following.append((node, clash))
        if ended < 0:
            raise RuntimeError("no reading ends here; the ranks are not those of a BPE vocabulary")
        return self._state(tuple(following), self._class(ended)), ended

    def _trace(self, ends: list[int], position: int) -> list[int]:
        """The tokens of the reading that ends at a position."""
        length, out = self.vocabulary.length, []
        while position:
            token = ends[position - 1]
            out.append(token)
            position -= length[token]
        out.reverse()
        return out

    def _settle(self, state: _State, ends: list[int]) -> tuple[list[int], list[int]]:
        """The tokens that all open readings agree on, and what ends where after them."""
        depth, length = self.vocabulary.depth, self.vocabulary.length
        agreed = self._trace(ends, len(ends))
        for node, _ in state.readings:
            path = self._trace(ends, len(ends) - depth[node])
            shared = 0
            for mine, theirs in zip(agreed, path, strict=False):
                if mine != theirs:
                    break
                shared += 1
            del agreed[shared:]
        return agreed, ends[sum(length[token] for token in agreed) :]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, ends, out = self.start, [], []
        for first in range(0, len(piece), COMMIT):
            if first:
                agreed, ends = self._settle(state, ends)
                out += agreed
            for byte in piece[first : first + COMMIT]:
                state, token = state[byte]
                ends.append(token)
        out += self._trace(ends, len(ends))
        return out


class Encoder:
    """Whole texts to token ids."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.transducer = Transducer(vocabulary)
        self.pattern = regex.compile(pattern)
        # Encodings of recent pieces; those of the older generation move up when met again.
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            tokens = self.transducer.encode(piece.encode())
            ids = array(_UINT32, tokens).tobytes()
            if len(piece) > LONG_PIECE:
                return ids
        if len(self.pieces) >= MAX_PIECES:
            self.older, self.pieces = self.pieces, {}
        self.pieces[piece] = ids
        return ids

    def _pieces(self, text: str) -> Iterable[str]:
        if len(text) <= LONG_TEXT:
            return self.pattern.findall(text)
        return (match.group() for match in self.pattern.finditer(text))

    def encode(self, text: bytes | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        known, out = self.pieces.get, []
        for piece in self._pieces(text.decode("utf-8", "replace")):
            ids = known(piece)
            if ids is None:
                ids = self._encode(piece)
                known = self.pieces.get
            out.append(ids)
        return b"".join(out)


def _split_utf8(data: bytes) -> tuple[str, bytes]:
    """The text of all finished characters, and the bytes of a character still to be finished."""
    for back in range(1, min(3, len(data)) + 1):
        byte = data[-back]
        if byte >= 0xC0:
            length = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 0
            tail = data[len(data) - back :]
            # Unfinished only if some bytes could still complete it.
            if back < length and _can_continue(tail):
                return data[: len(data) - back].decode("utf-8", "replace"), tail
            break
        if byte < 0x80:
            break
    return data.decode("utf-8", "replace"), b""


def _can_continue(tail: bytes) -> bool:
    lead = tail[0]
    if lead < 0xC2:
        return False
    if len(tail) == 1:
        return True
    low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
    high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
    return low <= tail[1] <= high


class _DecoderState(dict):
    """Token id to (text, next state), for one unfinished character."""

    def __init__(self, decoder: Decoder, pending: bytes):
        super().__init__()
        self.decoder, self.pending = decoder, pending

    def __missing__(self, token: int) -> tuple[str, _DecoderState]:
        text, pending = _split_utf8(self.pending + self.decoder.tokens[token])
        step = self[token] = (text, self.decoder.state(pending))
        return step


class Decoder:
    """Token ids to text, in any number of parts."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.whole: dict[int, str] = {}
        for rank, token in tokens.items():
            text, pending = _split_utf8(token)
            if not pending and text.encode() == token:
                self.whole[rank] = text
        self.states: dict[bytes, _DecoderState] = {}
        self.start = self.state(b"")
        self.current = self.start

    def state(self, pending: bytes) -> _DecoderState:
        found = self.states.get(pending)
        if found is None:
            if len(self.states) > 4096:
                self.states = {b"": self.states[b""]}
            found = self.states[pending] = _DecoderState(self, pending)
        return found

    def push(self, ids: list[int]) -> str:
        """The text that these further ids complete."""
        state, out = self.current, []
        if state is self.start:
            try:  # tokens of whole characters need no state
                return "".join(map(self.whole.__getitem__, ids))
            except KeyError:
                pass
        for token in ids:
            text, state = state[token]
            out.append(text)
        self.current = state
        return "".join(out)

    def finish(self) -> str:
        """What is left at the end; the decoder is ready for another text."""
        text = self.current.pending.decode("utf-8", "replace")
        self.current = self.start
        return text

    def decode(self, data: bytes | None, step: int = 512) -> str:
        """The text of ids given as little-endian unsigned 32-bit numbers."""
        ids = np.frombuffer(data or b"", dtype="<u4")
        parts = [self.push(ids[at : at + step].tolist()) for at in range(0, len(ids), step)]
        return "".join([*parts, self.finish()])


_encoders: dict[tuple[str, str], Encoder] = {}
_decoders: dict[str, Decoder] = {}


def _encoder(name: str, pattern: str) -> Encoder:
    """One encoder for each file and pattern in a Python worker."""
    if (name, pattern) not in _encoders:
        _encoders[name, pattern] = Encoder(Vocabulary.load(SparkFiles.get(name)), pattern)
    return _encoders[name, pattern]


def _decoder(name: str) -> Decoder:
    """One decoder for each file in a Python worker; it shares an encoder's tokens if there is one."""
    if name not in _decoders:
        encoder = next((e for (n, _), e in _encoders.items() if n == name), None)
        if encoder is None:
            ranks = Vocabulary.read_ranks(SparkFiles.get(name))
            tokens = {rank: token for token, rank in ranks.items()}
        else:
            tokens = encoder.transducer.vocabulary.tokens
        _decoders[name] = Decoder(tokens)
    return _decoders[name]


def ship_file(frame: DataFrame, path: str) -> str:
    """Give every executor the rank file; the name under which they find it."""
    context = frame.sparkSession.sparkContext
    sent = getattr(context, "_orderflow_files", None)
    if sent is None:
        sent = context._orderflow_files = set()
    if path not in sent:
        context.addFile(path)
        sent.add(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, keep: list[str], text_col: str = "text"
) -> tuple[DataFrame, str]:
    """``keep`` and a struct with ``ids``, the tokens as little-endian unsigned 32-bit numbers.

    Returns the frame and the struct's name. Special tokens' strings are ordinary text.
    """
    name = ship_file(docs, ranks_path)

    def scan(texts: list[bytes | None]) -> list:
        return [list(map(_encoder(name, pattern).encode, texts))]

    return scan_texts(docs, text_col, keep, scan, "ids binary", "encoded")


def decode(
    frame: DataFrame, ranks_path: str, keep: list[str], ids_col: str
) -> tuple[DataFrame, str]:
    """``keep`` and a struct with ``text``, what the ids stand for; and the struct's name."""
    name = ship_file(frame, ranks_path)

    def scan(values: list[bytes | None]) -> list:
        return [list(map(_decoder(name).decode, values))]

    return scan_texts(frame, ids_col, keep, scan, "text string", "decoded")


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, keep: list[str], text_col: str = "text"
) -> tuple[DataFrame, str, str]:
    """``keep``, the ids, and the text decoded from them; the frame and these two columns' names.

    Both steps run in one Python worker, so an executor holds each vocabulary once per core.
    """
    name = ship_file(docs, ranks_path)

    def scan(texts: list[bytes | None]) -> list:
        ids = list(map(_encoder(name, pattern).encode, texts))
        return [ids, list(map(_decoder(name).decode, ids))]

    done, tokens = scan_texts(docs, text_col, keep, scan, "ids binary, text string", "encoded")
    back = free_name(done, "decoded")
    ids, text = F.col(f"{tokens}.ids"), F.col(f"{tokens}.text")
    return done.select(*keep, ids.alias(tokens), text.alias(back)), tokens, back



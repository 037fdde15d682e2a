"""Substring dedup: passages of 50 or more words that an earlier document has already are removed.

Matches are decided by suffix automata of words. A reference is what a document shares with others; a
later document is streamed through the automaton of each reference it may repeat, and the matching
statistics (the longest suffix read so far that the reference holds) give the maximal spans above
the threshold. The automata are not broadcast, because all references together grow with the
corpus: they are built where a join has brought a reference and its readers together, once for
each run of readers.

Who must read whom is found by hashes, which only route and never decide:

1. Equal word sequences are folded to the one with the smallest id; the others are repeats as a whole.
2. Every window of 50 words names its smallest hash of 10 consecutive words, its anchor. Documents
   that share a window share its anchor. Anchors of one document only are dropped.
3. Windows with a shared anchor are grouped by their own hash of 128 bits; of the passages holding a
   window, one of the smallest id is its owner, and each holder of a larger id reads that owner.

An id that is null counts as larger than all others. Null and blank texts have no words. Rows that
share an id are one document for the others, though each row gets its own result; up to the last step
they are told apart by a digest of their text, so an id (or a missing one) that a third of all rows
have is many small groups, and rows that are equal as well are folded before anything is joined. An
empty table gives an empty result. Ties between passages of one id go to the smaller hash; which one is
read changes nothing. Very long texts are cut into chunks of words; extra columns are ignored. Counting is by partial aggregation, so a
passage that a third of all documents share is one row per task before it is shuffled. Counts are
stored before they are joined back, so that both sides of such a join are plain shuffles, whose hot
partitions adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from orderflow.llm.common import scan_texts, ship_package, store

WINDOW = 50
GRAM = 10
SHARD_WORDS = 20_000  # of an automaton; longer references are cut, overlapping by a window
LAST = (1 << 63) - 1  # stands for a null id
_RANDOM = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 20
_powers = np.ones(1, dtype=np.uint64)


def _power_table(size: int) -> np.ndarray:
    global _powers
    if len(_powers) < size:
        steps = np.full(max(size, 2 * len(_powers)), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(joined: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text of words joined by one blank."""
    out, at = [], 0
    while at < len(joined):
        stop = joined.find(b" ", at + _CHUNK)
        part = joined[at : stop if stop >= 0 else len(joined)]
        data = np.frombuffer(part, dtype=np.uint8)
        starts = np.concatenate(([0], np.flatnonzero(data == 0x20) + 1))
        sizes = np.diff(np.append(starts, len(data) + 1))
        offset = np.arange(len(data)) - np.repeat(starts, sizes)[: len(data)]
        values = _RANDOM[data] * _power_table(int(sizes.max()) + 1)[offset]
        values[starts[1:] - 1] = 0
        out.append(_mix(np.add.reduceat(values, starts) + sizes.astype(np.uint64)))
        at += len(part) + 1
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words, from those of half as many."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    powers = _power_table(size + 1)
    level, span, done = hashes, 1, 0
    while span <= size:
        if size & span:
            total = total * powers[span] + level[done : done + n]
            done += span
        if 2 * span <= size:
            level = level[:-span] * powers[span] + level[span:]
        span *= 2
    return _mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    span, level = 1, values
    while 2 * span <= width:
        level = np.minimum(level[:-span], level[span:])
        span *= 2
    return np.minimum(level[:n], level[width - span : width - span + n])


def anchors(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The anchor of every window."""
    return sliding_min(gram_hashes(hashes, gram), window - gram + 1)


class SuffixAutomaton:
    """All substrings of some sequences of words."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for k, words in enumerate(sequences):
            if k:
                last = self._extend(last, k)  # a number is no word, so nothing spans two sequences
            for word in words:
                last = self._extend(last, word)

    def _extend(self, last: int, symbol: bytes | int) -> int:
        follow, link, length = self.next, self.link, self.length
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in follow[at]:
            follow[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = follow[at][symbol]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and follow[at].get(symbol) == target:
                    follow[at][symbol] = copy
                    at = link[at]
                link[target] = link[new] = copy
        return new

    def spans(self, words: list[bytes], least: int) -> list[tuple[int, int]]:
        """Maximal runs of words covered by matches of at least ``least`` words."""
        follow, link, length = self.next, self.link, self.length
        state = matched = 0
        found: list[tuple[int, int]] = []
        for at, word in enumerate(words):
            while state and word not in follow[state]:
                state = link[state]
                matched = length[state]
            after = follow[state].get(word)
            if after is None:
                matched = 0
                continue
            state, matched = after, matched + 1
            if matched >= least:
                start = at - matched + 1
                if found and start <= found[-1][1]:
                    found[-1] = (min(found[-1][0], start), at + 1)
                else:
                    found.append((start, at + 1))
        return found


def _summarise(texts: list[bytes | None], window: int, gram: int) -> list:
    counts, digests, found = [], [], []
    for text in texts:
        joined = b" ".join(text.split()) if text else b""
        hashes = word_hashes(joined)
        counts.append(len(hashes))
        digests.append(hashlib.sha256(joined).digest())
        found.append(np.unique(anchors(hashes, window, gram)).view(np.int64))
    offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
    values = np.concatenate(found) if found else np.zeros(0, np.int64)
    return [counts, digests, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]


def summaries(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """doc_id, sid (the id that orders), n_words, digest of the joined words, and anchors."""
    def scan(texts: list[bytes | None]) -> list:
        return _summarise(texts, window, gram)

    keyed = _texts(docs, id_col, text_col)
    scanned, name = scan_texts(
        keyed, "text", ["doc_id", "sid", "text_key"], scan, "n_words int, digest binary, anchors array<long>"
    )
    return scanned.select("doc_id", "sid", "text_key", f"{name}.*")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, sid (the id that orders), text, and text_key (a digest that tells texts apart)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    number = F.col(id_col).cast("long")
    return docs.select(
        number.alias("doc_id"),
        F.coalesce(number, F.lit(LAST)).alias("sid"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"),
        text.alias("text"),
    )


def _first_code(sid: Column) -> Column:
    """The smallest code of an id: codes ascend by id, signed."""
    shifted = sid.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    return (shifted * F.lit(str(1 << 62)).cast("decimal(19,0)")).cast("decimal(38,0)")


def _code(sid: Column, digest: Column) -> Column:
    """A number for a passage that orders by id, then by 62 bits of its digest's hash.

    A plain number, because the smallest of it is found by hash aggregation.
    """
    tail = F.shiftrightunsigned(F.xxhash64(digest), 2).cast("decimal(20,0)")
    return (_first_code(sid) + tail).cast("decimal(38,0)")


def _shared_anchors(first: DataFrame) -> DataFrame:
    """sid, text_key and the anchors this text shares with documents of other ids."""
    each = first.select("sid", "text_key", F.explode("anchors").alias("anchor"))
    shared = store(
        each.groupBy("anchor")
        .agg(F.min("sid").alias("low"), F.max("sid").alias("high"))
        .where("low < high")
        .select("anchor"),
        "shared-anchors",
    )
    found = each.join(shared, "anchor").groupBy("sid", "text_key")
    return found.agg(F.collect_set("anchor").alias("shared"))


def _passages(joined: DataFrame, window: int, gram: int) -> DataFrame:
    """For each text with windows of shared anchors: its words, these windows' runs and hashes."""
    ship_package(joined.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            rows: dict[str, list] = {
                name: [] for name in ("sid", "digest", "words", "runs", "starts", "windows", "others")
            }
            texts = batch.column(1).cast(pa.binary())
            for k in range(batch.num_rows):
                text = texts[k].as_py()
                joined_words = b" ".join(text.split()) if text else b""
                hashes = word_hashes(joined_words)
                shared = np.sort(batch.column(2)[k].values.to_numpy())
                named = anchors(hashes, window, gram).view(np.int64)
                if not len(named):
                    continue
                at = np.minimum(np.searchsorted(shared, named), len(shared) - 1)
                hit = shared[at] == named
                if not hit.any():
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                words = joined_words.split(b" ")
                runs = [
                    b" ".join(words[a : b + window - 1])
                    for a, b in zip(edges[::2], edges[1::2], strict=True)
                ]
                rows["sid"].append(batch.column(0)[k].as_py())
                rows["digest"].append(hashlib.sha256(joined_words).digest())
                rows["words"].append(pack(joined_words))
                rows["runs"].append(pack(b"\n".join(runs)))
                rows["starts"].append(edges[::2].astype(np.int32))
                rows["windows"].append(gram_hashes(hashes, window)[hit].view(np.int64))
                rows["others"].append(gram_hashes(_mix(hashes ^ _BASE), window)[hit].view(np.int64))
            kinds = [
                pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()),
                pa.list_(pa.int64()), pa.list_(pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows)
            )

    return joined.select("sid", F.col("text").cast("string"), "shared").mapInArrow(
        run,
        "sid long, digest binary, words binary, runs binary, starts array<int>, windows array<long>, "
        "others array<long>",
    )


def shard_runs(runs: list[list[bytes]], window: int, size: int) -> Iterator[list[list[bytes]]]:
    """The runs in lists of about ``size`` words; each window of them is whole in some list."""
    shard, filled = [], 0
    for words in runs:
        for at in range(0, max(1, len(words) - window + 1), size):
            part = words[at : at + size + window - 1]
            if shard and filled + len(part) > size:
                yield shard
                shard, filled = [], 0
            shard.append(part)
            filled += len(part)
    if shard:
        yield shard


def _shards(passages: DataFrame, window: int) -> DataFrame:
    """owner and reference: what each document shares with others, in shards of bounded size."""
    ship_package(passages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            owners, references = [], []
            for k in range(batch.num_rows):
                runs = [r.split(b" ") for r in unpack(batch.column(1)[k].as_py()).split(b"\n")]
                for shard in shard_runs(runs, window, SHARD_WORDS):
                    owners.append(batch.column(0)[k].as_py())
                    references.append(pack(b"\n".join(map(b" ".join, shard))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners, pa.decimal128(38, 0)), pa.array(references, pa.binary())],
                names=["owner", "reference"],
            )

    return passages.select("code", "runs").mapInArrow(run, "owner decimal(38,0), reference binary")


def _read(pairs: DataFrame, window: int) -> DataFrame:
    """Stream readers through the automata of their references; rows sorted by reference reuse one."""
    ship_package(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        built, automaton = None, None
        for batch in batches:
            sids, digests, starts, ends = [], [], [], []
            columns = [batch.column(i) for i in range(5)]
            for k in range(batch.num_rows):
                reference = columns[0][k].as_py()
                if reference != built:
                    built = reference
                    automaton = SuffixAutomaton([r.split(b" ") for r in unpack(reference).split(b"\n")])
                runs = unpack(columns[3][k].as_py()).split(b"\n")
                for first, words in zip(columns[4][k].as_py(), runs, strict=True):
                    for start, end in automaton.spans(words.split(b" "), window):
                        sids.append(columns[1][k].as_py())
                        digests.append(columns[2][k].as_py())
                        starts.append(first + start)
                        ends.append(first + end)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sids, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                ],
                names=["sid", "digest", "start", "end"],
            )

    return pairs.mapInArrow(run, "sid long, digest binary, start int, end int")


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def remove_words(words: list[bytes], merged: list[tuple[int, int]]) -> list[bytes]:
    """The words outside merged spans."""
    out, at = [], 0
    for start, end in merged:
        out += words[at:start]
        at = end
    return out + words[at:]


def _cut(joined: DataFrame) -> DataFrame:
    """Words left after removing the spans; ``spans`` are word positions, merged and sorted."""
    ship_package(joined.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            spans, removed, kept = [], [], []
            for k in range(batch.num_rows):
                words = unpack(batch.column(2)[k].as_py()).split(b" ")
                merged = merge_spans([(s["start"], s["end"]) for s in batch.column(3)[k].as_py()])
                out = remove_words(words, merged)
                spans.append([{"start": a, "end": b} for a, b in merged])
                removed.append(sum(b - a for a, b in merged))
                kept.append(hashlib.sha256(b" ".join(out)).digest())
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(spans, span),
                    pa.array(removed, pa.int64()), pa.array(kept, pa.binary()),
                ],
                names=["sid", "digest", "spans", "n_removed", "kept"],
            )

    return joined.select("sid", "digest", "words", "found").mapInArrow(
        run,
        "sid long, digest binary, spans array<struct<start:int,end:int>>, n_removed long, kept binary",
    )


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans and kept_sha256.

    ``spans`` are the removed runs of words, as half-open word positions; ``kept_sha256`` is the
    digest (hex) of the other words joined by one blank. Runs several jobs; intermediate tables are in
    the shared folder.
    """
    all_rows = store(summaries(docs, id_col, text_col, window, gram), "summaries")
    first = store(
        all_rows.groupBy("digest").agg(F.min("sid").alias("first_sid")), "first-copies"
    )
    firsts = all_rows.where(F.col("n_words") >= window).join(
        first.withColumnRenamed("first_sid", "sid"), ["digest", "sid"], "left_semi"
    )
    shared = _shared_anchors(firsts.dropDuplicates(["sid", "digest"]))

    # Partial aggregation leaves one copy of rows that are equal in id and text.
    texts = _texts(docs, id_col, text_col).select("sid", "text_key", "text")
    once = texts.groupBy("sid", "text_key").agg(F.first("text").alias("text"))
    found_passages = _passages(once.join(shared, ["sid", "text_key"]), window, gram)
    passages = store(
        found_passages.withColumn("code", _code(F.col("sid"), F.col("digest"))), "passages"
    )

    windows = F.explode(F.arrays_zip("windows", "others")).alias("w")
    held = passages.select("sid", "code", windows).select(
        "sid", "code", F.col("w.windows").alias("window"), F.col("w.others").alias("other")
    )
    owners = store(
        held.groupBy("window", "other")
        .agg(F.min("code").alias("owner"), F.max("sid").alias("last"))
        .where(F.col("owner") < _first_code(F.col("last")))
        .select("window", "other", "owner"),
        "owners",
    )
    later = F.col("owner") < _first_code(F.col("sid"))
    pairs = held.join(owners, ["window", "other"]).where(later).select("code", "owner").distinct()
    readers = pairs.join(passages.select("code", "sid", "digest", "runs", "starts"), "code")
    together = readers.join(_shards(passages, window), "owner").select("reference", "sid", "digest", "runs", "starts")
    found = (
        _read(together, window)
        .groupBy("sid", "digest")
        .agg(F.collect_set(F.struct("start", "end")).alias("found"))
    )
    cut = _cut(passages.select("sid", "digest", "words").join(found, ["sid", "digest"]))
    cut = store(cut.dropDuplicates(["sid", "digest"]), "cuts")

    whole_copy = (F.col("sid") > F.col("first_sid")) & (F.col("n_words") >= window)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end")))
    none = F.lit([]).cast("array<struct<start:int,end:int>>")
    return (
        all_rows.drop("anchors")
        .join(first, "digest")
        .join(cut, ["sid", "digest"], "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.when(whole_copy, F.col("n_words"))
            .otherwise(F.coalesce("n_removed", F.lit(0)))
            .cast("long")
            .alias("n_removed"),
            F.when(whole_copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
            F.when(whole_copy, F.sha2(F.lit(b""), 256))
            .otherwise(F.lower(F.hex(F.coalesce("kept", "digest"))))
            .alias("kept_sha256"),
        )
    )

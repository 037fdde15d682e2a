"""Near duplicates by SimHash: every pair of distinct fingerprints is compared, tile by tile.

A fingerprint has 64 bits. Distinct fingerprints are laid out in tiles of bounded size, ordered by
their numbers of set bits (of the whole word and of its four quarters). A pair of tiles is skipped
when these numbers differ by more than the radius, because each differing bit changes them by one.
The remaining pairs are compared in full with numpy exclusive-or and bit counts, so no link is lost.
A pair of tiles returns the links of a spanning forest, never all pairs of a group.

Null, empty and blank texts have fingerprint zero. Rows with the same fingerprint (exact copies) are
compared once. Extra columns are ignored. A null id gets a fingerprint and a component like any
other row, but never names a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from orderflow.llm.common import free_name, scan_texts, ship_package, store
from orderflow.llm.components import connected_components

SEED = 42
SHINGLE = 3
BITS = 64
RADIUS = 3
TILE_ROWS = 4096
QUARTERS = tuple(np.uint64(0xFFFF << (16 * i)) for i in range(4))
# Words of very long texts are handled this many at a time.
CHUNK_WORDS = 1 << 18


def simhash(text: bytes | None) -> int:
    """The fingerprint of one text as an unsigned number."""
    if not text:
        return 0
    words = text.lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    counts = np.zeros(BITS, dtype=np.int64)
    total = len(words) - SHINGLE + 1
    digest = xxhash.xxh64_intdigest
    for first in range(0, total, CHUNK_WORDS):
        part = words[first : first + CHUNK_WORDS + SHINGLE - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = len(part) - SHINGLE + 1
        hashes = np.fromiter(
            (
                digest(joined[i:j], SEED)
                for i, j in zip(starts[:n].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
            ),
            dtype=np.uint64,
            count=n,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: list[bytes | None]) -> list:
    values = np.fromiter(map(simhash, texts), dtype=np.uint64, count=len(texts))
    return [values.view(np.int64)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``fp``, the fingerprint's bits as a signed long."""
    scanned, result = scan_texts(docs, text_col, [id_col], _fingerprints, "fp long")
    return scanned.select(F.col(id_col).alias("doc_id"), F.col(f"{result}.fp").alias("fp"))


def signatures(fps: np.ndarray) -> np.ndarray:
    """Set bits of each quarter, as one row of four numbers per fingerprint."""
    return np.stack([np.bitwise_count(fps & mask) for mask in QUARTERS], axis=1).astype(np.int16)


def encode_signatures(quarters: np.ndarray) -> np.ndarray:
    """Signatures as numbers that sort by the total first (4,901,... < 65 * 17 ** 4 values)."""
    q = quarters.astype(np.int64)
    code = q.sum(axis=1)
    for i in range(4):
        code = code * 17 + q[:, i]
    return code


class Layout:
    """Which tile each signature's fingerprints go to, and which tiles may hold links.

    There are at most 17 ** 4 = 83,521 signatures, whatever the data, so their counts fit on the
    driver and in a broadcast. Neighbouring signatures share a tile up to ``tile_rows``; a larger
    signature is split over several tiles by a hash of the fingerprint.
    """

    def __init__(self, codes: np.ndarray, quarters: np.ndarray, counts: np.ndarray, tile_rows: int):
        order = np.argsort(codes)
        self.codes = codes[order]
        self.first = np.zeros(len(codes), dtype=np.int64)
        self.split = np.ones(len(codes), dtype=np.int64)
        lows, highs = [], []
        filled, tile = 0, -1
        for k, at in enumerate(order):
            count, box = int(counts[at]), self._box(quarters[at])
            if count > tile_rows:
                parts = -(-count // tile_rows)
                self.first[k], self.split[k] = tile + 1, parts
                lows += [box] * parts
                highs += [box] * parts
                tile, filled = tile + parts, tile_rows
                continue
            if tile < 0 or filled + count > tile_rows:
                lows.append(box)
                highs.append(box)
                tile, filled = tile + 1, 0
            self.first[k] = tile
            filled += count
            lows[tile] = np.minimum(lows[tile], box)
            highs[tile] = np.maximum(highs[tile], box)
        self.low = np.array(lows, dtype=np.int16).reshape(-1, 5)
        self.high = np.array(highs, dtype=np.int16).reshape(-1, 5)

    @staticmethod
    def _box(quarters: np.ndarray) -> np.ndarray:
        return np.append(quarters, quarters.sum())

    def tiles(self, fps: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, encode_signatures(signatures(fps)))
        mixed = (fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[at] + (mixed.astype(np.int64) % self.split[at])

    def near(self, tile: int, radius: int) -> np.ndarray:
        """All tiles whose set-bit counts are within the radius of this tile's."""
        gap = np.maximum(self.low - self.high[tile], self.low[tile] - self.high)
        gap = np.maximum(gap, 0)
        return np.flatnonzero((gap[:, :4].sum(axis=1) <= radius) & (gap[:, 4] <= radius))


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    while True:
        up = parent[nodes]
        if np.array_equal(up, nodes):
            return nodes
        nodes = up


def _unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the trees of linked nodes, smaller root on top."""
    while True:
        a, b = _roots(parent, left), _roots(parent, right)
        apart = a != b
        if not apart.any():
            return
        left, right = left[apart], right[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def compare_tiles(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of two tiles of fingerprints (of one with itself if ``b`` is None)."""
    a = np.sort(a)
    a = a[np.argsort(encode_signatures(signatures(a)), kind="stable")]
    if b is None:
        other, nodes, shift = a, a, 0
    else:
        other = b[np.argsort(encode_signatures(signatures(b)), kind="stable")]
        nodes, shift = np.concatenate([a, other]), len(a)
    parent = np.arange(len(nodes))
    sig_a, start_a = np.unique(encode_signatures(signatures(a)), return_index=True)
    sig_b, start_b = np.unique(encode_signatures(signatures(other)), return_index=True)
    end_a, end_b = np.append(start_a[1:], len(a)), np.append(start_b[1:], len(other))
    quarters_a, quarters_b = signatures(a[start_a]), signatures(other[start_b])
    for k in range(len(sig_a)):
        gaps = np.abs(quarters_b - quarters_a[k]).sum(axis=1)
        found = gaps <= radius
        if b is None:
            found &= sig_b >= sig_a[k]
        groups = np.flatnonzero(found)
        if not len(groups):
            continue
        columns = np.concatenate([np.arange(start_b[g], end_b[g]) for g in groups])
        rows = np.arange(start_a[k], end_a[k])
        step = max(1, (1 << 22) // len(columns))
        for at in range(0, len(rows), step):
            block = rows[at : at + step]
            close = np.bitwise_count(a[block][:, None] ^ other[columns][None, :]) <= radius
            i, j = np.nonzero(close)
            left, right = block[i], columns[j]
            if b is None:
                later = right > left
                left, right = left[later], right[later]
            if len(left):
                _unite(parent, left, right + shift)
    roots = _roots(parent, np.arange(len(nodes)))
    moved = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[moved], nodes[roots[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that span each linked group."""
    spark = distinct.sparkSession
    ship_package(spark)
    parts = [F.bit_count(F.col("fp").bitwiseAND(F.lit(int(m.view(np.int64))))) for m in QUARTERS]
    histogram = (
        distinct.select(*[p.alias(f"q{i}") for i, p in enumerate(parts)])
        .groupBy("q0", "q1", "q2", "q3")
        .count()
        .collect()  # at most 83,521 rows
    )
    quarters = np.array([row[:4] for row in histogram], dtype=np.int16).reshape(-1, 4)
    counts = np.array([row[4] for row in histogram], dtype=np.int64)
    layout = spark.sparkContext.broadcast(
        Layout(encode_signatures(quarters), quarters, counts, tile_rows)
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = layout.value
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            if not len(fps):
                continue
            tiles = plan.tiles(fps)
            order = np.argsort(tiles, kind="stable")
            present, starts = np.unique(tiles[order], return_index=True)
            low, high, side, data = [], [], [], []
            for tile, start, end in zip(
                present.tolist(), starts, np.append(starts[1:], len(fps)), strict=True
            ):
                block = fps[order[start:end]].tobytes()
                for other in plan.near(tile, radius).tolist():
                    low.append(min(tile, other))
                    high.append(max(tile, other))
                    side.append(int(tile > other))
                    data.append(block)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(side, pa.int32()),
                    pa.array(data, pa.binary()),
                ],
                names=["low", "high", "side", "data"],
            )

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        sides = table.column("side").to_pylist()
        data = table.column("data").to_pylist()
        halves = [
            np.frombuffer(b"".join(d for d, s in zip(data, sides, strict=True) if s == k), np.uint64)
            for k in (0, 1)
        ]
        same = key[0].as_py() == key[1].as_py()
        u, v = compare_tiles(halves[0], None if same else halves[1], radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "low long, high long, side int, data binary")
    return dealt.groupBy("low", "high").applyInArrow(compare, "u long, v long")


def _with_roots(nodes: DataFrame, value: str, radius: int, tile_rows: int) -> DataFrame:
    """``fp``, the given column and ``root``, one fingerprint of the group that ``fp`` is linked to."""
    labels = connected_components(links(nodes, radius, tile_rows))
    return nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", value, F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``.

    The component is the smallest id of all documents reachable over links of ``radius`` or fewer
    differing bits. Runs several jobs and keeps its intermediate tables in the shared folder.
    """
    prints = store(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fp-nodes")
    labelled = _with_roots(nodes, "first_id", radius, tile_rows)
    smallest = store(
        labelled.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest-ids"
    )
    components = labelled.join(smallest, "root").select("fp", "component_id")
    return prints.join(components, "fp").select("doc_id", "fp", "component_id")


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row of each component, with all columns: that of the smallest id, nulls last.

    Rows are told apart by a number of their own, so ids may repeat or be null. Among equal ids the
    smallest hash of the row decides, and among equal rows any one stays.
    """
    row, rank = free_name(docs, "row"), free_name(docs, "rank")
    # Stored, because the rows' numbers must be the same whenever they are read.
    stored = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    hashed = [F.to_json(F.struct(name)) if "map<" in kind else F.col(name) for name, kind in docs.dtypes]
    key = F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
        F.xxhash64(*hashed).alias("hash"), F.col(row).alias("row"),
    )
    # Only the text and this key go through Python.
    scanned, result = scan_texts(stored.withColumn(rank, key), text_col, [rank], _fingerprints, "fp long")
    ranked = scanned.select(F.col(f"{result}.fp").alias("fp"), F.col(rank).alias("first"))
    nodes = store(ranked.groupBy("fp").agg(F.min("first").alias("first")), "fp-first-rows")
    first = _with_roots(nodes, "first", radius, tile_rows).groupBy("root").agg(F.min("first").alias("first"))
    kept = first.select(F.col("first.row").alias(row))
    return stored.join(kept, row, "left_semi").select(*docs.columns)

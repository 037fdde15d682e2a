"""Exact k nearest binary codes by incremental multi-index hashing.

A 64-bit code is cut into four segments of 16 bits. If two codes differ in at most 4 r + 3 bits, some
segment differs in at most r. Each block of codes is indexed by the values of its segments; for a
query the segments' search radius r grows by one until the k-th smallest verified distance is at most
4 r + 3, so that no unseen code can be closer. Each block answers exactly; the blocks' answers
are merged by Spark, k rows per query and block, with partial selection before the shuffle.

Queries and codes are dealt to random blocks of about QUERY_BLOCK and INDEX_ROWS rows, and every pair of
blocks is a group of its own, in which the codes are indexed and all its queries answered. Nothing is
broadcast and nothing passes through the driver but the two row counts.
Ties are ordered by id. Rows without a vector (null, or with a null element among the first 64) have
no code and are neither found nor asked for. Vectors shorter than 64 are filled up with zero bits.
A query is not its own neighbour: the row with the query's id is left out. Repeated ids
are separate rows of the index. An empty table, or no queries, give an empty result; of a vector longer than 64
the rest is ignored. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from orderflow.llm.common import ship_package, store

BITS = 64
SEGMENTS = 4
WIDTH = BITS // SEGMENTS
QUERY_BLOCK = 1 << 12  # queries in one group
INDEX_ROWS = 1 << 16  # codes in one index
NO_ID = -(1 << 63)  # stands for a missing id inside an index

_masks: dict[int, np.ndarray] = {}


def flips(radius: int) -> np.ndarray:
    """All segment values with exactly ``radius`` bits set."""
    if radius not in _masks:
        _masks[radius] = np.array(
            [sum(1 << bit for bit in bits) for bits in combinations(range(WIDTH), radius)],
            dtype=np.int64,
        )
    return _masks[radius]


class Index:
    """Codes sorted by each segment's value."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        self.order, self.first = [], []
        for k in range(SEGMENTS):
            values = self.segment(codes, k)
            self.order.append(np.argsort(values, kind="stable"))
            counts = np.bincount(values, minlength=1 << WIDTH)
            self.first.append(np.concatenate(([0], np.cumsum(counts))))

    @staticmethod
    def segment(codes: np.ndarray, k: int) -> np.ndarray:
        return ((codes >> np.uint64(WIDTH * k)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)

    def _bucket_rows(self, k: int, values: np.ndarray) -> np.ndarray:
        first = self.first[k]
        starts, sizes = first[values], first[values + 1] - first[values]
        starts, sizes = starts[sizes > 0], sizes[sizes > 0]
        if not len(starts):
            return self.order[k][:0]
        shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return self.order[k][np.arange(int(sizes.sum())) + shift]

    def nearest(self, code: np.uint64, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances and row numbers of the k nearest, ordered by distance and id."""
        seen = np.zeros(len(self.codes), dtype=bool)
        rows = np.zeros(0, dtype=np.int64)
        distances = np.zeros(0, dtype=np.int64)
        for radius in range(WIDTH + 1):
            for part in range(SEGMENTS):
                own = int(self.segment(np.array([code]), part)[0])
                found = self._bucket_rows(part, own ^ flips(radius))
                found = found[~seen[found]]
                seen[found] = True
                found = found[self.ids[found] != query_id]
                rows = np.concatenate([rows, found])
                verified = np.bitwise_count(self.codes[found] ^ code).astype(np.int64)
                distances = np.concatenate([distances, verified])
            covered = SEGMENTS * radius + SEGMENTS - 1
            if len(rows) >= k and np.partition(distances, k - 1)[k - 1] <= covered:
                break
            if seen.all():
                break
        best = np.lexsort((self.ids[rows], distances))[:k]
        return distances[best], rows[best]


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``code``: bit i is set if element i is positive."""
    vector = F.col(vector_col)
    bits = [
        F.when(F.coalesce(F.try_element_at(vector, F.lit(i + 1)), F.lit(0.0)) > 0, F.lit(1))
        .otherwise(F.lit(0))
        .cast("long")
        for i in range(BITS)
    ]
    code = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(b, i) for i, b in enumerate(bits)])
    usable = vector.isNotNull() & ~F.exists(F.slice(vector, 1, BITS), lambda x: x.isNull())
    return vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), code.alias("code"))


def _in_blocks(df: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """A stored copy with a random ``block`` number, and the number of blocks of about ``size`` rows."""
    rows = store(df.select("id", "code"), name)
    blocks = max(1, -(-rows.count() // size))
    # By row and not by code, so that copies of one code are spread like any other rows.
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    return rows.withColumn("block", number), blocks


def _search(k: int):
    def search(key: tuple, table: pa.Table) -> pa.Table:
        asked = table.filter(table.column("is_query"))
        held = table.filter(pc.invert(table.column("is_query")))
        ids = held.column("id").combine_chunks()
        index = Index(
            held.column("code").to_numpy().view(np.uint64), ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        )
        query_ids, query_codes = asked.column("id").to_numpy(), asked.column("code").to_numpy()
        counts, near, away = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for query_id, code in zip(query_ids.tolist(), query_codes.view(np.uint64), strict=True):
            distances, rows = index.nearest(code, query_id, k)
            counts.append(len(rows))
            near.append(rows)
            away.append(distances)
        return pa.table(
            {
                "query_id": np.repeat(query_ids, counts),
                "query_code": np.repeat(query_codes, counts),
                "neighbour_id": ids.take(pa.array(np.concatenate(near))),
                "distance": np.concatenate(away),
            }
        )

    return search


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), neighbour_id and distance of each query's k nearest codes.

    Both frames have ``id`` and ``code``. Queries without an id are left out, and repeated ones are
    asked once; an id with several codes is a query for each, with ranks of its own. Stores both frames.
    """
    ship_package(codes.sparkSession)
    asked = queries.where("id is not null").select("id", "code").distinct()
    held, code_blocks = _in_blocks(codes, INDEX_ROWS, "codes")
    asked, query_blocks = _in_blocks(asked, QUERY_BLOCK, "code-queries")
    # Every block of queries meets every block of codes; a group has at most about one of each.
    pairs = held.select(
        "id", "code", F.col("block").alias("code_block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
        F.lit(False).alias("is_query"),
    ).union(
        asked.select(
            "id", "code", F.explode(F.sequence(F.lit(0), F.lit(code_blocks - 1))),
            F.col("block"), F.lit(True),
        )
    )
    found = pairs.groupBy("code_block", "query_block").applyInArrow(
        _search(k), "query_id long, query_code long, neighbour_id long, distance long"
    )
    order = Window.partitionBy("query_id", "query_code").orderBy(
        "distance", F.col("neighbour_id").asc_nulls_last()
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "neighbour_id", "distance")
    )

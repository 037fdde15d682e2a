"""Product codes of vectors: integer k-means per part of the vector, with norm-of-sum bounds.

Every vector is cut into equal parts; each part position has a codebook of its own, which starts from the
vectors of the smallest ids and is refined in a fixed number of rounds.

Method: each part keeps its entry, an upper bound of the distance to it, and a lower bound of the
distance to all other entries, each bound with the round it was computed in (its stamp). The codebooks of all
rounds are kept. A bound is carried to the present by the *net* displacement of an entry, which is
the norm of the sum of its moves since the stamp, and not the sum of their norms: entries that
wander back and forth lose nothing. Only where the carried bounds cannot separate the entry from the others is the
distance to the entry computed, and only where that does not help all entries are rescanned.

* All distances that decide are integers; bounds are floating point with a margin, and only a strictly
  smaller upper bound skips a rescan, so ties still go to the lower index.
* A round is one pass: each task emits its rows with their new state and one row of totals, and the
  table is written to the shared folder, so a lost executor costs its tasks. Sums over all rows are
  aggregated by Spark; the driver gets entries * (part length + 1) numbers per part, whatever the size
  of the table. What is shipped to tasks is the history of the codebooks, which is bounded by the rounds.
* Components are stored as integers beside the state; the table of the round before is deleted.

Cases: rows whose vector is null, or holds a null, NaN or infinite component, are dropped. Vectors of
another length than the first, of a length the parts do not divide, or with components too large for
64-bit distances are an error with a message. With fewer rows than entries, the codebooks have as many
entries as rows; an empty table gives empty results. Rows of equal id are ordered by their vectors,
missing ids come last; repeated rows are coded like any others. Labels that are null form one group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from orderflow.llm.common import drop_stored, free_name, ship_package, store, to_arrow

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Relative margin of the bounds, above the rounding of roots, sums and the single precision they are kept in.
MARGIN = 1e-6
# Rows handled at a time within a task.
BLOCK_ROWS = 4096
STATE = (
    "code binary, upper array<float>, lower array<float>, upper_round binary, lower_round binary, totals array<long>"
)
CODED = "code binary, error long"


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and finite in every component."""
    bad = F.exists(
        vector_col,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    return vectors.where(F.col(vector_col).isNotNull() & ~bad)


def largest_component(length: int) -> int:
    """Integer components up to this give squared distances whose sum fits in 64 bits."""
    return int((2**62 / max(1, length)) ** 0.5 / 2)


def squared_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to the entries of one codebook."""
    return np.stack([((x - entry) ** 2).sum(axis=1) for entry in book], axis=1)


@dataclass
class State:
    """Per row and part: entry, bounds, and the rounds they are from."""

    code: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_round: np.ndarray
    lower_round: np.ndarray
    rescanned: int = 0

    @classmethod
    def unknown(cls, rows: int, parts: int) -> State:
        shape = (rows, parts)
        return cls(
            np.zeros(shape, np.uint8), np.full(shape, np.inf), np.zeros(shape),
            np.zeros(shape, np.uint8), np.zeros(shape, np.uint8),
        )


def displacements(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Net moves from each round to the last, and the largest move among all other entries.

    ``history`` is (rounds, parts, entries, length); both results are (rounds, parts, entries).
    """
    moved = (history - history[-1]).astype(np.float64)
    own = np.sqrt((moved**2).sum(axis=3)) * (1 + MARGIN)
    others = np.zeros_like(own)
    for entry in range(own.shape[2]):
        rest = np.delete(own, entry, axis=2)
        others[:, :, entry] = rest.max(axis=2) if rest.shape[2] else 0
    return own, others


def assign(x: np.ndarray, state: State, history: np.ndarray) -> State:
    """The state after assigning integer rows (rows, parts, length) to the last codebooks of the history."""
    own, others = displacements(history)
    now, books = len(history) - 1, history[-1]
    for part in range(x.shape[1]):
        code = state.code[:, part]
        upper = state.upper[:, part] + own[state.upper_round[:, part], part, code]
        lower = state.lower[:, part] - others[state.lower_round[:, part], part, code]
        open_rows = np.flatnonzero(upper >= lower)
        if not len(open_rows):
            continue
        values = x[open_rows, part]
        near = ((values - books[part][code[open_rows]]) ** 2).sum(axis=1)
        state.upper[open_rows, part] = np.sqrt(near) * (1 + MARGIN)
        state.upper_round[open_rows, part] = now
        still = np.flatnonzero(state.upper[open_rows, part] >= lower[open_rows])
        if not len(still):
            continue
        rows = open_rows[still]
        distances = squared_distances(values[still], books[part])
        best = distances.argmin(axis=1)
        nearest = distances[np.arange(len(rows)), best]
        state.code[rows, part] = best
        state.upper[rows, part] = np.sqrt(nearest) * (1 + MARGIN)
        if distances.shape[1] > 1:
            rest = distances.copy()
            rest[np.arange(len(rows)), best] = np.iinfo(np.int64).max
            state.lower[rows, part] = np.sqrt(rest.min(axis=1)) * (1 - MARGIN)
        else:
            state.lower[rows, part] = np.inf
        state.upper_round[rows, part] = now
        state.lower_round[rows, part] = now
        state.rescanned += len(rows)
    return state


def entry_totals(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """Counts and component sums per part and entry: (parts, entries, 1 + length)."""
    parts, length = x.shape[1:]
    totals = np.zeros((parts, entries, 1 + length), np.int64)
    for part in range(parts):
        order = np.argsort(code[:, part], kind="stable")
        found, starts = np.unique(code[order, part], return_index=True)
        ends = np.append(starts[1:], len(order))
        totals[part, found, 0] = ends - starts
        totals[part, found, 1:] = np.add.reduceat(x[order, part], starts, axis=0)
    return totals


def refine(book: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The codebooks' next round: floor of the mean of each entry's rows; unused entries stay."""
    counts, sums = totals[:, :, :1], totals[:, :, 1:]
    return np.where(counts > 0, sums // np.maximum(counts, 1), book)


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of an Arrow list or binary column, all of one length, as a matrix."""
    if pa.types.is_list(column.type):
        flat = column.flatten().to_numpy(zero_copy_only=False)
    else:
        flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return flat.reshape(len(column), -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values, np.uint8)], pa.binary())


def _read_state(batch: pa.RecordBatch, first: int) -> State:
    code, upper, lower, upper_round, lower_round = (
        np.array(_matrix(batch.column(first + k))) for k in range(5)
    )
    return State(code, upper.astype(np.float64), lower.astype(np.float64), upper_round, lower_round)


def _write_state(state: State) -> list[pa.Array]:
    bounds = [_lists(values.astype(np.float32), pa.float32()) for values in (state.upper, state.lower)]
    return [_bytes(state.code), *bounds, _bytes(state.upper_round), _bytes(state.lower_round)]


def _integers(vectors: DataFrame, keep: list[str], vector_col: str, x: str) -> DataFrame:
    scaled = F.transform(vector_col, lambda c: F.floor(c.cast("double") * SCALE))
    return store(vectors.select(*keep, scaled.cast("array<long>").alias(x)), "integer-vectors")


def _checked_length(rows: DataFrame, x: str, parts: int) -> int:
    """The length of all vectors; an error if they differ or cannot be handled exactly."""
    limits = rows.agg(
        F.min(F.size(x)), F.max(F.size(x)), F.min(F.array_min(x)), F.max(F.array_max(x))
    ).first()
    shortest, longest, least, most = limits
    if shortest is None:
        return 0
    if shortest != longest or longest % parts or not longest:
        raise ValueError(f"vectors of {shortest} to {longest} components cannot be cut into {parts} equal parts")
    if max(-least, most) > largest_component(longest):
        raise ValueError(f"vector components beyond {largest_component(longest) / SCALE:.6g} are not supported")
    return longest


def _first_books(rows: DataFrame, id_col: str, x: str, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors of the smallest ids: (parts, entries, length)."""
    chosen = rows.orderBy(F.col(id_col).asc_nulls_last(), F.col(x)).limit(entries).select(x).collect()
    vectors = np.array([row[0] for row in chosen], np.int64)
    return vectors.reshape(len(vectors), parts, -1).swapaxes(0, 1)


def _pass(rows: DataFrame, keep: list[str], x: str, history: np.ndarray, last: bool) -> DataFrame:
    """One round over all rows: their new state and a row of totals per task, or codes and errors."""
    ship_package(rows.sparkSession)
    parts, entries, length = history.shape[1:]
    width = len(keep)
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in rows.select(*keep).schema])
    names = _state_names(rows.select(*keep))
    fresh = names["code"] not in rows.columns
    result = free_name(rows.select(*keep), "coded")
    if last:
        schema = kept.add(result, T._parse_datatype_string(CODED))
    else:
        schema = kept.add(x, T.ArrayType(T.LongType()))
        for field in T._parse_datatype_string(STATE).fields:
            schema = schema.add(names[field.name], field.dataType)
    kinds = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, 1 + length), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                values = _matrix(part.column(width)).reshape(part.num_rows, parts, length)
                state = State.unknown(part.num_rows, parts) if fresh else _read_state(part, width + 1)
                state = assign(values, state, history)
                columns = part.columns[:width]
                if last:
                    near = history[-1][np.arange(parts), state.code]
                    error = ((values - near) ** 2).sum(axis=(1, 2))
                    coded = [_bytes(state.code), pa.array(error, pa.int64())]
                    columns.append(pa.StructArray.from_arrays(coded, names=["code", "error"]))
                else:
                    totals += entry_totals(values, state.code, entries)
                    nothing = pa.nulls(part.num_rows, pa.list_(pa.int64()))
                    columns += [part.column(width), *_write_state(state), nothing]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(k.type) for c, k in zip(columns, kinds, strict=True)], names=schema.names
                )
        if not last:
            columns = [pa.nulls(1, k.type) for k in kinds]
            columns[-1] = _lists(totals.reshape(1, -1), pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    inputs = [*keep, x] if fresh else [*keep, x, *list(names.values())[:-1]]
    source = rows if fresh else rows.where(F.col(names["totals"]).isNull())
    return source.select(*inputs).mapInArrow(run, schema)


def _state_names(kept: DataFrame) -> dict[str, str]:
    return {f.name: free_name(kept, f"{f.name}_") for f in T._parse_datatype_string(STATE).fields}


def _sum_totals(table: DataFrame, totals: str, shape: tuple[int, ...]) -> np.ndarray:
    each = table.where(F.col(totals).isNotNull()).select(F.posexplode(totals).alias("at", "value"))
    summed = np.zeros(int(np.prod(shape)), np.int64)
    for at, value in each.groupBy("at").agg(F.sum("value")).collect():
        summed[at] = value
    return summed.reshape(shape)


def encode(
    vectors: DataFrame,
    keep: Iterable[str],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, str, np.ndarray]:
    """Usable rows with a struct of ``code`` (a byte per part) and ``error``; its name; the codebooks.

    The result holds the columns in ``keep``; the codebooks are (parts, entries, length). The error is the squared
    distance to the coded vector. Runs a job per round; the result is stored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte, so a codebook has 1 to 256 entries")
    keep = list(keep)
    chosen = usable(vectors, vector_col)
    kept = chosen.select(*keep)
    x, key = free_name(kept, "integers_"), free_name(kept, "order_")
    table = _integers(chosen.withColumn(key, F.col(id_col)), [*keep, key], vector_col, x)
    length = _checked_length(table, x, parts)
    if not length:
        empty = F.lit(None).cast(T._parse_datatype_string(CODED))
        name = free_name(kept, "coded")
        return kept.limit(0).withColumn(name, empty), name, np.zeros((parts, 0, 0), np.int64)
    history = _first_books(table, key, x, parts, entries)[None]
    totals = _state_names(kept)["totals"]
    for _ in range(rounds):
        following = store(_pass(table, keep, x, history, last=False), "codebook-round")
        drop_stored(table)
        table = following
        shape = (*history.shape[1:3], 1 + history.shape[3])
        book = refine(history[-1], _sum_totals(table, totals, shape))
        history = np.concatenate([history, book[None]])
    coded = store(_pass(table, keep, x, history, last=True), "codes")
    drop_stored(table)
    return coded, coded.columns[-1], history[-1]


def text_of(books: np.ndarray) -> str:
    """All components by part, entry and position, joined by commas."""
    return ",".join(str(value) for value in books.ravel().tolist())


def group_errors(coded: DataFrame, name: str, label_col: str) -> DataFrame:
    """Stored sums of the errors, one row per label, as ``label`` and ``label_error``; null is a label too."""
    summed = coded.groupBy(F.col(label_col).alias("label")).agg(F.sum(f"{name}.error").alias("label_error"))
    return store(summed, "label-errors")

"""Lines that many documents share, removed from all of them; DataFrame functions only.

Method: normalised lines are exploded and hashed, the documents of each hash are counted, lines whose
hash reaches the threshold are dropped by position, and the other lines are joined again by position.

* A line's key is the line without blanks, tabs, line feeds, vertical tabs, form feeds and carriage
  returns at both ends, with A-Z in lower case. Its hash has 128 bits (two seeds of XXH64).
* Every row is a document of its own, so repeated rows and repeated or missing ids count as often as
  they occur. A line that stands several times in one row counts once: keys are made distinct within
  the row before they are exploded, so counting needs no distinct shuffle, and partial counts leave
  one row per hash and map task of a line that a third of all documents hold.
* The counts are stored before they are joined back: Spark then knows their size, broadcasts them
  only if they are small, and can split a hot hash otherwise, since both sides are plain shuffles.
* Only positions of dropped lines are shuffled, and the texts once, by row number, to meet them. What
  meets in one task is one row's text and positions. Rows are numbered in a stored copy, because
  the numbers must be the same whenever they are read, also after the loss of an executor.

Cases: a null or empty text is one empty line. Empty keys are never dropped, as long as the shortest
key to drop has at least one code point. There are no ties: a count either reaches the threshold or
not. An empty table gives an empty table. Very long texts are handled whole; time and memory are in
proportion to the text. Other columns, of any type, pass through; the result's name gets underscores
appended if a kept column has it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.llm.common import free_name, store

MIN_DOCUMENTS = 10
MIN_CHARS = 1
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The normalised line; ``lower`` does the same as ``translate`` for ASCII, but much faster."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("low"), F.xxhash64(F.lit("high"), key).alias("high")]


def frequent_lines(
    docs: DataFrame, text_col: str, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Hashes (``low``, ``high``) of the keys in at least ``min_documents`` rows, and ``n_documents``."""
    keys = F.array_distinct(F.transform(split_lines(F.col(text_col).cast("string")), line_key))
    each = docs.select(F.explode(keys).alias("key")).where(F.char_length("key") >= min_chars)
    counted = each.select(*_hashes(F.col("key"))).groupBy("low", "high")
    return counted.agg(F.count("*").alias("n_documents")).where(F.col("n_documents") >= min_documents)


def drop_frequent_lines(
    docs: DataFrame,
    keep: Iterable[str],
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
) -> tuple[DataFrame, str]:
    """The columns in ``keep`` and a struct of ``n_lines``, ``n_dropped`` and the ``kept`` text.

    Returns the frame and the struct's name. Runs two jobs: the numbered copy and the counts.
    """
    keep = list(keep)
    kept = docs.select(*keep)
    names = ["cut", "row_", "text_", "dropped_", "lines_"]
    result, row, text, dropped, lines = (free_name(kept, name) for name in names)
    numbered = docs.select(
        *keep,
        F.col(text_col).cast("string").alias(text),
        F.monotonically_increasing_id().alias(row),
    )
    stored = store(numbered, "numbered-texts")
    frequent = store(frequent_lines(stored, text, min_documents, min_chars), "frequent-lines")

    placed = stored.select(row, F.posexplode(split_lines(F.col(text))).alias("position", "line"))
    keyed = placed.select(row, "position", line_key(F.col("line")).alias("key"))
    hashed = keyed.where(F.char_length("key") >= min_chars).select(
        row, "position", *_hashes(F.col("key"))
    )
    found = hashed.join(frequent.select("low", "high"), ["low", "high"])
    positions = found.groupBy(row).agg(F.collect_list("position").alias(dropped))

    # The lines are used more than once below, so they are split once per row and not per line.
    joined = stored.join(positions, row, "left").withColumn(lines, split_lines(F.col(text)))
    size = F.size(lines)
    left = F.array_except(F.sequence(F.lit(0), size - 1), F.col(dropped))
    rest = F.array_join(F.transform(left, lambda at: F.get(F.col(lines), at)), "\n")
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = F.struct(
        size.cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col(dropped).isNull(), whole).otherwise(rest).alias("kept"),
    )
    return joined.select(*keep, cut.alias(result)), result

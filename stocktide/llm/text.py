"""Shared reading helpers: the columns an operator needs, words, and Arrow batches.

Extra columns of an input are never carried through an operator, so their names cannot
clash with working columns. A null text counts as empty, a null id stays null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SLICE_BYTES = 4 << 20  # texts that a task turns into Python objects at once
SLICE_ROWS = 1 << 11


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), and other columns by name."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *others
    )


def text_key(text: str | Column = "text") -> Column:
    """Tells rows with the same id and different texts apart when rows are joined back."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def words_of(text: bytes) -> list[bytes]:
    """Runs without space, tab, line feed, vertical tab, form feed or carriage return."""
    return text.split()


def texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` bytes and ``rows`` rows; a longer row is a run of its own."""
    size = np.full(batch.num_rows, most // rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // most)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if end > start:
            yield batch.slice(start, end - start)


def gathered(values: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``picks`` of a table one after the other, and their sizes; row i holds ``sizes[i]`` of ``values``."""
    starts = np.cumsum(sizes) - sizes
    picked = sizes[picks]
    before = np.cumsum(picked) - picked
    return values[np.repeat(starts[picks] - before, picked) + np.arange(picked.sum())], picked


def over_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on slices of each Arrow batch. Spark bounds a batch in rows, and the slice bounds the copies
    that ``work`` makes of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = work(part)
                if made is not None:
                    yield made

    return df.mapInArrow(run, schema)


def rows_back(docs: DataFrame, keys: DataFrame, columns: list[str] | None = None, carry: str | None = None) -> DataFrame:
    """The rows of ``docs`` named by ``keys`` (``doc_id``, ``text_key``, unique), one row for
    each key although a row may be there twice. Null ids match null ids. ``carry`` names a column
    of ``keys`` to bring along."""
    keep = columns or [c for c in DOCUMENT_COLUMNS if c in docs.columns]
    more = [carry] if carry else []
    # the same plain columns join and remove repeats, so texts are shuffled once
    place = {"_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), "_no_id": F.col("doc_id").isNull()}
    left = docs.select(*keep).withColumns({**place, "_text_key": text_key()})
    right = keys.select(*[c.alias(name) for name, c in place.items()], F.col("text_key").alias("_text_key"), *more)
    on = [*place, "_text_key"]
    return left.join(right, on, "inner" if carry else "left_semi").dropDuplicates(on).select(*keep, *more)

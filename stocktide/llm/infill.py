"""Fill-in-the-middle texts, cut with a Fenwick tree over fixed blocks of each text.

A text is cut twice between units (code points, or words with the white space behind them). The
tree holds the units and the code points of every block of ``BLOCK`` bytes. A cut descends it by
binary lifting to the block in which its unit starts and is then found inside that one block, so a
long text is scanned once for its counts and twice over one block, however many units it has.

Nulls count as empty texts, and a null id as an empty one when the seeded numbers are drawn. Rows
with the same id and text are separate rows with the same result. An empty text, a text with one of
the marks and a seeded share of the others stay as they are (``plain``). A very long text needs
one byte of counts for each of its bytes while it is cut. Other columns are left out, so their names
cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.text import narrow, over_batches, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
BLOCK = 1024  # bytes
UNITS = ("code_point", "word")

_P, _S, _M = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class BlockTree:
    """Fenwick tree of pairs (units, code points), one pair for each block."""

    def __init__(self, counts: np.ndarray):
        self.tree = [(0, 0), *map(tuple, counts.tolist())]
        for at in range(1, len(self.tree)):
            above = at + (at & -at)
            if above < len(self.tree):
                self.tree[above] = (self.tree[above][0] + self.tree[at][0], self.tree[above][1] + self.tree[at][1])
        self.step = 1 << max(0, (len(self.tree) - 1).bit_length() - 1)

    def descend(self, unit: int) -> tuple[int, int, int]:
        """The block in which ``unit`` (from 0) starts, and the units and code points before that block."""
        at = units = points = 0
        step = self.step
        while step:
            if at + step < len(self.tree) and units + self.tree[at + step][0] <= unit:
                at += step
                units, points = units + self.tree[at][0], points + self.tree[at][1]
            step >>= 1
        return at, units, points


class Cutter:
    """Where the units of one text start."""

    def __init__(self, text: bytes, unit: str = "code_point", block: int = BLOCK):
        body = np.frombuffer(text, np.uint8)
        self.size, self.block = len(text), block
        self.points = (body & 0xC0) != 0x80
        if unit == "code_point":
            self.starts = self.points
        else:
            space = _SPACE[body]
            self.starts = ~space & np.concatenate([[True], space[:-1]]) if self.size else self.points
        firsts = np.arange(0, self.size, block)
        sums = [np.add.reduceat(flags, firsts, dtype=np.int64) for flags in (self.starts, self.points)] if self.size else [[], []]
        self.units, self.length = int(np.sum(sums[0])), int(np.sum(sums[1]))
        self.tree = BlockTree(np.column_stack(sums)) if self.size else None

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points before the place behind the first ``units`` units. What comes before the
        first unit goes with it, and all of the text lies before the end of the last one."""
        if units == 0:
            return 0, 0
        if units >= self.units:
            return self.size, self.length
        block, before, points = self.tree.descend(units)
        first = block * self.block
        at = int(np.flatnonzero(self.starts[first : first + self.block])[units - before])
        return first + at, points + int(np.count_nonzero(self.points[first : first + at]))


def rearranged(text: bytes, draws: tuple[int, int, int, int], unit: str = "code_point", block: int = BLOCK) -> tuple:
    """n, form, output, code points of prefix and of middle (None where plain)."""
    cutter = Cutter(text, unit, block)
    n = cutter.units
    if not text or _P in text or _S in text or _M in text or draws[2] % 100 >= PLAIN_FROM:
        return n, "plain", text, None, None
    (first, before), (last, through) = (cutter.cut(k) for k in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if draws[3] % 100 < SPM_BELOW:
        return n, "spm", b"".join((_S, suffix, _P, prefix, _M, middle)), before, through - before
    return n, "psm", b"".join((_P, prefix, _S, suffix, _M, middle)), before, through - before


def transformed(docs: DataFrame, unit: str = "code_point", seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """doc_id, n, form, output, prefix_chars, middle_chars for every row of ``docs``."""
    if unit not in UNITS:
        raise ValueError(f"units are {UNITS}")
    schema = "doc_id bigint, n bigint, form string, output string, prefix_chars bigint, middle_chars bigint"
    drawn = ["h1", "h2", "h3", "h4"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        draws = zip(*(batch.column(name).to_pylist() for name in drawn))
        made = [rearranged(text, own, unit, block) for text, own in zip(texts(batch.column("text")), draws)]
        n, form, output, prefix, middle = zip(*made)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form), pa.array(output, pa.binary()).view(pa.string()),
                pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
            ],
            names=["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"],
        )

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(name) for i, name in enumerate(drawn)]
    return over_batches(narrow(docs).select("doc_id", "text", *numbers), work, schema)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text an output was made of. No part holds a mark, and no mark can begin inside another, so
    the marks in an output are the ones put there."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    other = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    at = F.position(other, head)
    first = F.substr(head, F.lit(len(PREFIX) + 1), at - F.lit(len(PREFIX) + 1))
    second = F.substr(head, at + F.lit(len(PREFIX)))
    parts = F.when(form == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))
    return F.when(form == "plain", output).otherwise(parts)


def query(docs: DataFrame) -> DataFrame:
    made = transformed(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )

"""Manifest of a dataset as a tree of hashes, and proofs that a row is in it.

Every row is a leaf. The leaves of a source ascend by id; runs of three consecutive nodes become one
node until one is left, the source's root. The roots of all sources, ordered by source, become the
root of the dataset in the same way.

Only every ``LEVELS``-th level is stored. A block is an aligned subtree between two stored levels, at
most 3 ** LEVELS nodes, and is all a task holds at a time. Proofs go from the top down: with the
proof of a block's root at hand, the missing levels of the block are computed again from its
stored nodes, the proofs of those nodes are emitted, and the levels are dropped. So a source with a
third of all rows is many blocks, and neither leaves nor proofs meet in one task.

A null is a value of its own in every field, also as id or source (both first in their order). Empty and
very long texts are hashed by Spark and never shuffled. Rows with the same id are ordered by hash;
equal rows are separate leaves. Other columns are left out, so their names cannot clash. An empty
table has no root, no leaves and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.operators.ordered import in_ranges, numbered
from stocktide.session import staged

FANOUT = 3
LEVELS = 6  # between two stored levels
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ROWS = 1 << 12  # proofs of a batch

_NODES = "grp bigint, pos bigint, n bigint, node string"
_STEPS = "places string, sizes string, siblings string"


# ---- hashes -------------------------------------------------------------------------------------


def joined_hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf_hash(**changed: Column) -> Column:
    """Hash of a row's fields, each with its length in front."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        own = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(own, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def climb(nodes: list[str], total: int, height: int = LEVELS) -> list[list[str]]:
    """Levels of a block from its nodes up; ``total`` is how many nodes the whole level has."""
    levels = [nodes]
    while total > 1 and len(levels) <= height:
        below = levels[-1]
        levels.append([joined_hash(below[at : at + FANOUT]) for at in range(0, len(below), FANOUT)])
        total = -(-total // FANOUT)
    return levels


def fold(leaf: str, places: str, sizes: str, siblings: str) -> str:
    """The root a leaf leads to: on each level it stands at its place among the siblings of its run."""
    node, at = leaf, 0
    for place, size in zip(map(int, places), map(int, sizes)):
        middle, end = at + 64 * place, at + 64 * (size - 1)
        node = hashlib.sha256((siblings[at:middle] + node + siblings[middle:end]).encode()).hexdigest()
        at = end
    return node


# ---- blocks -------------------------------------------------------------------------------------


def _block(height: int) -> Column:
    return F.expr(f"pos div {FANOUT**height}")


def _over_blocks(rows: DataFrame, order: list[str], work: Callable[[pa.Table], Iterator[dict]], schema: str, arrow: pa.Schema) -> DataFrame:
    """``work`` on the rows of each (grp, block), in the given order; at most one block is held back between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, made = None, []
        for batch in chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            if held is None or not held.num_rows:
                continue
            grp, block = held.column("grp").to_numpy(), held.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(grp) != 0) | (np.diff(block) != 0)) + 1).tolist()]
            if batch is None:
                cuts.append(held.num_rows)
            for start, end in zip(cuts, cuts[1:]):
                made.extend(work(held.slice(start, end - start)))
                while len(made) >= ROWS:
                    yield pa.RecordBatch.from_pylist(made[:ROWS], arrow)
                    made = made[ROWS:]
            held = held.slice(cuts[-1])
        if made:
            yield pa.RecordBatch.from_pylist(made, arrow)

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "grp", "block").sortWithinPartitions("grp", "block", *order).mapInArrow(run, schema)


def _schema(**kinds: pa.DataType) -> pa.Schema:
    return pa.schema(list(kinds.items()))


def _stored_levels(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Stored levels (grp, pos, n, node) from ``nodes`` up to the one with a single node in every group."""
    reach = FANOUT**height

    def work(block: pa.Table) -> Iterator[dict]:
        total = block.column("n")[0].as_py()
        top = climb(block.column("node").to_pylist(), total, height)[-1]
        yield {"grp": block.column("grp")[0].as_py(), "pos": block.column("block")[0].as_py(), "n": -(-total // reach), "node": top[0]}

    arrow = _schema(grp=pa.int64(), pos=pa.int64(), n=pa.int64(), node=pa.string())
    levels = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rows = levels[-1].select("grp", "pos", "n", "node").withColumn("block", _block(height))
        levels.append(staged(_over_blocks(rows, ["pos"], work, _NODES, arrow), "merkle-level"))
        most = -(-most // reach)
    return levels


def _proofs_below(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Proofs of ``nodes`` (grp, pos, n, node and what else is to be kept) from the proofs of their blocks' roots
    (grp, pos, places, sizes, siblings, subroot, root): the proof's own rows travel with the block's nodes."""
    more = [c for c in nodes.columns if c not in ("grp", "pos", "n", "node")]
    kinds = dict(nodes.dtypes)
    carried = ["places", "sizes", "siblings", "subroot", "root"]
    own = nodes.withColumn("block", _block(height)).withColumn("kind", F.lit(1))
    tops = above.select("grp", F.col("pos").alias("block"), *carried).withColumn("kind", F.lit(0))
    rows = tops.unionByName(own, allowMissingColumns=True)

    def work(block: pa.Table) -> Iterator[dict]:
        first = block.slice(0, 1).to_pylist()[0]
        block = block.slice(1)
        total, nodes_ = block.column("n")[0].as_py(), block.column("node").to_pylist()
        levels, start = climb(nodes_, total, height), block.column("block")[0].as_py() * FANOUT**height
        others = {name: block.column(name).to_pylist() for name in more}
        # steps of a node above the lowest level are the same for its run: made once each, from the top down
        steps = [("", "", "")]
        for level in range(len(levels) - 2, -1, -1):
            row, made = levels[level], []
            for at in range(len(row)):
                left = at - at % FANOUT
                run = row[left : left + FANOUT]
                places, sizes, siblings = steps[at // FANOUT]
                made.append((f"{at % FANOUT}{places}", f"{len(run)}{sizes}", "".join(run[: at - left] + run[at - left + 1 :]) + siblings))
            steps = made
        for at, (places, sizes, siblings) in enumerate(steps):
            yield {
                "grp": first["grp"], "pos": start + at, "node": nodes_[at], "places": places + first["places"], "sizes": sizes + first["sizes"],
                "siblings": siblings + first["siblings"], "subroot": first["subroot"], "root": first["root"],
                **{name: values[at] for name, values in others.items()},
            }

    types = {"bigint": pa.int64(), "string": pa.string()}
    texts = ("node", "places", "sizes", "siblings", "subroot", "root")
    arrow = _schema(grp=pa.int64(), pos=pa.int64(), **{name: pa.string() for name in texts}, **{name: types[kinds[name]] for name in more})
    schema = ", ".join(["grp bigint, pos bigint", *(f"{name} string" for name in texts), *(f"{name} {kinds[name]}" for name in more)])
    return _over_blocks(rows, ["kind", "pos"], work, schema, arrow)


# ---- manifest -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """Stored levels of all sources (``levels[0]`` holds the leaves) and of the tree over their roots; ``sources`` names the groups."""

    levels: list[DataFrame]
    top: list[DataFrame]
    sources: DataFrame
    height: int = LEVELS

    def root(self) -> str | None:
        found = self.top[-1].select("node").first()
        return found and found["node"]


def hashed_rows(docs: DataFrame, **changed: Column) -> DataFrame:
    """doc_id, source, leaf, and ``altered``: the leaf of the row with some columns changed."""
    given = docs.select(*[F.col(name).cast("bigint" if name in ("doc_id", "n_chars") else "string").alias(name) for name in FIELDS])
    return given.select("doc_id", "source", leaf_hash().alias("leaf"), leaf_hash(**changed).alias("altered"))


def manifest(hashed: DataFrame, height: int = LEVELS) -> Manifest:
    """Trees over rows (doc_id, source, leaf, and what else the leaves shall keep), stored every ``height`` levels."""
    more = [c for c in hashed.columns if c not in ("doc_id", "source", "leaf")]
    rows = staged(hashed.withColumn("uid", F.monotonically_increasing_id()), "merkle-rows")
    first = F.col("source").asc_nulls_first()
    ranged = in_ranges(rows, first, F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("uid"))
    # a run is what one range partition holds of a source
    runs = ranged.groupBy("_part", "source").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    runs = staged(runs, "merkle-runs")
    own = Window.partitionBy("source")
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sources = staged(numbered(runs.select("source").distinct(), [first], "grp", 0), "merkle-sources")
    placed = runs.select(
        "_part", "source", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(own).alias("n")
    ).alias("r")
    placed = placed.join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select("r.*", "s.grp").alias("p")
    same = (F.col("d._part") == F.col("p._part")) & F.col("d.source").eqNullSafe(F.col("p.source"))
    leaves = ranged.alias("d").join(placed, same).select(
        "grp", (F.col("_pos") - F.col("_first") + F.col("_before")).alias("pos"), "n", F.col("leaf").alias("node"), "doc_id", *more
    )
    levels = _stored_levels(staged(leaves, "merkle-leaves"), height)
    count = sources.count()
    roots = levels[-1].select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("pos"), F.lit(count).cast("bigint").alias("n"), "node")
    return Manifest(levels, _stored_levels(roots, height), sources, height)


def proofs(made: Manifest) -> DataFrame:
    """Every leaf (grp, pos, node, doc_id, ...) with subroot, root, and its proof from the leaf up to the root: the
    place in its run and the size of the run on each level (digits), and all siblings (64 hex digits each)."""
    blank = [F.lit("").alias(name) for name in ("places", "sizes", "siblings")]
    above = made.top[-1].select("grp", "pos", *blank, F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for nodes in made.top[-2::-1]:
        above = staged(_proofs_below(nodes, above, made.height), "merkle-proofs")
    if len(made.top) == 1:
        above = above.join(made.top[0].select("grp", "pos", "node"), ["grp", "pos"])
    above = above.select(F.col("pos").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "places", "sizes", "siblings", F.col("node").alias("subroot"), "root")
    for nodes in made.levels[-2:0:-1]:
        above = staged(_proofs_below(nodes, above, made.height), "merkle-proofs")
    if len(made.levels) == 1:
        return made.levels[0].drop("n").join(above, ["grp", "pos"])
    return _proofs_below(made.levels[0], above, made.height)


def folded(proved: DataFrame, leaf: str, name: str = "folded_root") -> DataFrame:
    """``proved`` with the root that its proofs give for the hashes in column ``leaf``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (leaf, "places", "sizes", "siblings"))
            roots = pa.array([fold(*row) for row in zip(*columns)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, roots], names=[*batch.schema.names, name])

    schema = ", ".join([*(f"{c} {kind}" for c, kind in proved.dtypes), f"{name} string"])
    return proved.mapInArrow(run, schema)


def query(docs: DataFrame, height: int = LEVELS) -> DataFrame:
    """Proofs of all rows, tried with texts that lost their line feeds where 2 divides the CRC-32 of the id."""
    tampered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    text = F.coalesce(tampered, F.col("text"))
    made = proofs(manifest(hashed_rows(docs, text=text), height))
    return folded(made, "altered").select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

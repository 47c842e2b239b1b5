"""Near-duplicates by what they share: Jaccard similarity of sets of five-word shingles, links from ``ALIKE``.

Texts with equal sets are one node. Candidates come first from op7's fingerprints, which Golay-code keys join
within four differing bits. At similarity 0.8 fingerprints often differ in more bits, so candidates are also pairs that share
one of 32 bands of four MinHash values (a pair at similarity 0.8 shares none once in about 10^7 pairs, a
more similar pair still less often) and agree in 0.6 of all 128 values (5.7 standard deviations below 0.8).
What either joins is a cluster, and every link inside a cluster is decided by the whole sets.

Bands and clusters are joined in the same way (``joined``). Rows meet in cells of at most two blocks, and a
cell returns a spanning forest: one row that was compared with all others for each link, at most as many
links as rows, and never its pairs. Rows joined already (in bands: by fingerprints or before) aren't compared, so
the rows outside the largest part of a cell are the ones that are. A group larger than a block is first joined
block by block, with some rows of the group in every block; then only what is outside its largest part meets the
rest of the group. A set is sent once for each cell of its cluster, however many bands it shares.

Nulls and texts without words are one node, texts shorter than five words have one shingle. A null id is
kept and comes first where one row of a group stays; equal rows are one row there. Very long texts are
sets of their own size and make their blocks smaller. Other columns are not used, so their names
cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm import simhash
from stocktide.llm.components import components
from stocktide.llm.text import gathered, narrow, over_batches, text_key, texts, words_of
from stocktide.session import staged

SHINGLE = 5
ALIKE = 0.8
BANDS, DEEP = 32, 4
MAYBE = 0.6  # share of equal MinHash values from which a pair is in one cluster
BLOCK = 1024  # rows of a cell come from at most two blocks
ITEMS = 1 << 20  # shingles of a block, more only where one text has more
HEADS = 32  # rows of a large group that are in each of its blocks
CHUNK = 1024

_RANDOM = np.random.default_rng(42)
_TIMES = _RANDOM.integers(0, 1 << 63, BANDS * DEEP, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, BANDS * DEEP, np.uint64)
_MIX = _RANDOM.integers(0, 1 << 63, (BANDS, 2), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words; a shorter text is one run, one without words has none."""
    words = words_of(text.lower())
    if not words:
        return np.empty(0, np.uint64)
    reach = min(SHINGLE, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    cut = zip((ends - lengths)[: len(words) - reach + 1].tolist(), ends[reach - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[s:e]) for s, e in cut), np.uint64, len(words) - reach + 1))


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * DEEP, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        low = np.minimum(low, (hashes[at : at + CHUNK, None] * _TIMES + _PLUS).min(axis=0))
    return low


def node_of(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).view(np.int64))


def nodes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, node, fp (op7's fingerprint, signed), mark (a byte of each MinHash value), bands (their keys)
    for every row, written once."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, prints, marks, bands = [], [], [], []
        for text in texts(batch.column("text")):
            hashes = shingles(text)
            low = signature(hashes)
            made.append(node_of(hashes))
            prints.append(simhash.fingerprint(text))
            marks.append((low >> np.uint64(40)).astype(np.uint8).tobytes())
            pairs = (low >> np.uint64(32)).astype("<u4").view("<u8").reshape(BANDS, 2)
            keys = pairs * _MIX
            bands.append(((keys[:, 0] ^ (keys[:, 1] >> np.uint64(29))) * _MIX[:, 1] + keys[:, 1]).view(np.int64))
        flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * BANDS), pa.array(flat))
        signed = pa.array(np.array(prints, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(made, pa.int64()), signed, pa.array(marks, pa.binary()), listed],
            names=["doc_id", "text_key", "node", "fp", "mark", "bands"],
        )

    rows = narrow(docs).withColumn("text_key", text_key())
    return staged(over_batches(rows, work, "doc_id bigint, text_key bigint, node bigint, fp bigint, mark binary, bands array<bigint>"), "shingle-nodes")


class Marks:
    """Estimates from a byte of each MinHash value."""

    def __init__(self, values: list[bytes]):
        self.mark = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)

    def like(self, at: int, others: np.ndarray) -> np.ndarray:
        return (self.mark[others] == self.mark[at]).mean(axis=1) >= MAYBE


class Sets:
    """Whole sets of a cell, by what holds each shingle."""

    def __init__(self, values: list[bytes]):
        self.sizes = np.fromiter(map(len, values), np.int64, len(values)) // 8
        self.ends = np.cumsum(self.sizes)
        shingle, self.number = np.unique(np.frombuffer(b"".join(values), "<u8"), return_inverse=True)
        self.holders = np.repeat(np.arange(len(values)), self.sizes)[np.argsort(self.number, kind="stable")]
        self.holding = np.bincount(self.number, minlength=len(shingle))

    def like(self, at: int, others: np.ndarray) -> np.ndarray:
        own = self.number[self.ends[at] - self.sizes[at] : self.ends[at]]
        holders, _ = gathered(self.holders, self.holding, own)
        shared = np.bincount(holders, minlength=len(self.sizes))[others]
        return shared >= ALIKE * (self.sizes[at] + self.sizes[others] - shared) - 1e-9


def forest(fragment: np.ndarray, like: Callable) -> Iterator[tuple[int, int]]:
    """Links that join all parts (equal ``fragment``) with rows alike. Only rows outside the largest
    part that is still to be compared are: two rows are joined already, or one of them was compared with the other."""
    part = np.unique(fragment, return_inverse=True)[1]
    left = np.arange(len(part))
    while len(left):
        outside = left[part[left] != np.bincount(part[left]).argmax()]
        if not len(outside):
            return
        at = int(outside[0])
        left = left[left != at]
        others = np.flatnonzero(part != part[at])
        hits = others[like(at, others)] if len(others) else others
        found, first = np.unique(part[hits], return_index=True)
        for hit in hits[first].tolist():
            yield at, hit
        part[np.isin(part, found)] = part[at]


def _links_of_cells(cells: DataFrame, payload: DataFrame, kind: type) -> DataFrame:
    """Links (a, b), a < b, of the rows (cell, node, fragment) of each cell, by their ``value`` in ``payload``."""

    def made(table: pa.Table) -> pa.RecordBatch | None:
        cell, node = table.column("cell").to_numpy(), table.column("node").to_numpy()
        fresh = np.concatenate([[True], (np.diff(cell) != 0) | (np.diff(node) != 0)])  # a row may be dealt to its cell twice
        table = table.filter(pa.array(fresh))
        cell, node, fragment = (table.column(c).to_numpy() for c in ("cell", "node", "fragment"))
        edges = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]]).tolist()
        left, right = [], []
        for start, end in zip(edges, edges[1:]):
            if end - start > 1 and len(np.unique(fragment[start:end])) > 1:
                values = kind(table.column("value").slice(start, end - start).to_pylist())
                for a, b in forest(fragment[start:end], values.like):
                    left.append(node[start + a])
                    right.append(node[start + b])
        a, b = np.array(left, np.int64), np.array(right, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cell = held.column("cell").to_numpy()
            cut = int(np.searchsorted(cell, cell[-1], "left")) if len(cell) else 0
            if cut:
                yield made(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield made(held)

    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cells.join(payload.select("node", "value"), "node").select("cell", "node", "fragment", "value")
    return rows.repartition(tasks, "cell").sortWithinPartitions("cell", "node").mapInArrow(work, "a bigint, b bigint").distinct()


def in_fragments(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (node) with the ``fragment`` that ``labels`` (node, component) put each into, or one of its own."""
    labels = labels.select("node", F.col("component").alias("fragment"))
    return rows.join(labels, "node", "left").withColumn("fragment", F.coalesce("fragment", "node"))


def _blocks(rows: Column, items: Column, block: int) -> Column:
    return F.greatest(F.ceil(rows / block), F.ceil(items / ITEMS)).cast("int")


def _every(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def joined(members: DataFrame, payload: DataFrame, kind: type, label: str, block: int = BLOCK, known: DataFrame | None = None) -> DataFrame:
    """Stored links (a, b) that join what is alike inside each group of ``members`` (grp, node, fragment, items). Rows of
    one ``fragment`` aren't compared: the links ``known``, which are not returned, join them already."""
    sizes = members.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("items").alias("all_items"), (F.min("fragment") < F.max("fragment")).alias("apart")
    )
    sizes = sizes.filter("apart").select("grp", _blocks(F.col("n"), F.col("all_items"), block).alias("blocks"))
    grouped = staged(members.join(sizes, "grp"), f"{label}-members")
    own = F.pmod(F.xxhash64("grp", "node"), F.col("blocks")).cast("int")
    large = grouped.filter("blocks > 1")
    heads = large.groupBy("grp", F.pmod(F.xxhash64("node"), F.lit(HEADS)).alias("slot")).agg(
        F.min(F.struct("node", "fragment")).alias("head"), F.first("blocks").alias("blocks")
    )
    first = grouped.select(F.xxhash64("grp", own).alias("cell"), "node", "fragment").unionAll(
        heads.select("grp", "head.*", _every(F.col("blocks")).alias("block")).select(F.xxhash64("grp", "block").alias("cell"), "node", "fragment")
    )
    sure = staged(_links_of_cells(first, payload, kind), f"{label}-links")
    if large.isEmpty():
        return sure

    placed = in_fragments(large.drop("fragment"), components(sure if known is None else sure.unionAll(known)))
    parts = placed.groupBy("grp", "fragment").agg(F.count(F.lit(1)).alias("n"))
    core = parts.groupBy("grp").agg(F.max(F.struct("n", "fragment")).getField("fragment").alias("core"))
    placed = placed.join(core, "grp").withColumn("core", F.col("fragment") == F.col("core"))
    counts = placed.groupBy("grp").agg(*[
        f.alias(name) for name, f in {
            "n_in": F.count_if("core"), "n_out": F.count_if(~F.col("core")),
            "items_in": F.sum(F.when(F.col("core"), F.col("items")).otherwise(0)),
            "items_out": F.sum(F.when(F.col("core"), 0).otherwise(F.col("items"))),
        }.items()
    ]).filter("n_out > 0")
    inner, outer = _blocks(F.col("n_in"), F.col("items_in"), block), _blocks(F.col("n_out"), F.col("items_out"), block)
    counts = counts.select("grp", inner.alias("inner"), outer.alias("outer"))
    hashed = F.xxhash64("node", "grp")
    cut = placed.drop("blocks").join(counts, "grp").withColumn(
        "own", F.when(F.col("core"), F.pmod(hashed, F.col("inner"))).otherwise(F.pmod(hashed, F.col("outer"))).cast("int")
    )
    inside, outside = cut.filter("core"), cut.filter("not core")

    def cell(df: DataFrame, name: str, i, j) -> DataFrame:
        return df.select(F.xxhash64("grp", F.lit(name), i, j).alias("cell"), "node", "fragment")

    other, own = F.col("other"), F.col("own")
    cells = (
        cell(inside.withColumn("other", _every(F.col("outer"))), "core", own, other)
        .unionAll(cell(outside.withColumn("other", _every(F.col("inner"))), "core", other, own))
        .unionAll(cell(outside.withColumn("other", _every(F.col("outer"))), "rest", F.least(own, other), F.greatest(own, other)))
    )
    return staged(sure.unionAll(_links_of_cells(cells, payload, kind)), f"{label}-all-links")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored sets (node, value, items) of the nodes ``wanted`` (node, text_key)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t) for t in texts(batch.column("text"))]
        values = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("node"), values, pa.array(map(len, sets), pa.int64())], names=["node", "value", "items"])

    bodies = docs.select(F.coalesce("text", F.lit("")).alias("text"), text_key().alias("text_key"))
    rows = bodies.join(wanted.select("node", "text_key"), "text_key").dropDuplicates(["node"]).select("node", "text")
    return staged(over_batches(rows, work, "node bigint, value binary, items bigint"), "shingle-sets")


def golay_groups(rows: DataFrame) -> DataFrame:
    """Stored node and component for the nodes of ``rows`` (node, fp) joined by near fingerprints, as ``components``
    returns them; equal sets may have several fingerprints, and equal fingerprints several sets."""
    seen = staged(rows.select("node", "fp").distinct(), "node-fingerprints")
    first = staged(seen.groupBy("fp").agg(F.min("node").alias("first")), "distinct-fingerprints")
    found = simhash.links(first)
    left, right = (first.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_node")) for end in ("a", "b"))
    near = found.join(left, "a").join(right, "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    same = seen.join(first, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    return staged(components(near.unionAll(same).filter("a <> b")), "golay-groups")


def links(docs: DataFrame, distinct: DataFrame, golay: DataFrame, block: int = BLOCK) -> DataFrame:
    """Verified links that join the nodes of ``distinct`` (node, text_key, mark, bands). Clusters are the groups
    ``golay`` (node, component), and what bands add to them."""
    near = golay.select(F.col("component").alias("a"), F.col("node").alias("b"))
    marks = distinct.select("node", F.col("mark").alias("value"))
    banded = in_fragments(distinct.select("node", "bands"), golay).select(
        F.explode("bands").alias("grp"), "node", "fragment", F.lit(0).cast("bigint").alias("items")
    )
    members = components(near.unionAll(joined(banded, marks, Marks, "band", block, near))).select("node", F.col("component").alias("grp"))
    clusters = staged(members.unionAll(members.select(F.col("grp").alias("node"), "grp").distinct()), "clusters")
    sets = shingle_sets(docs, clusters.join(distinct, "node"))
    alone = clusters.join(sets.select("node", "items"), "node").withColumn("fragment", F.col("node"))
    return joined(alone, sets, Sets, "set", block)


def near_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, text_key, node and component (its smallest node) for every row of ``docs``."""
    rows = nodes(docs)
    distinct = staged(
        rows.groupBy("node").agg(F.min("text_key").alias("text_key"), F.first("mark").alias("mark"), F.first("bands").alias("bands")),
        "distinct-nodes",
    )
    groups = components(links(docs, distinct, golay_groups(rows), block))
    return rows.select("doc_id", "text_key", "node").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def kept_rows(docs: DataFrame) -> DataFrame:
    """One row of each component stays, as with fingerprints."""
    return simhash.kept_rows(docs, near_groups)

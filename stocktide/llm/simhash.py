"""SimHash near-duplicates found through Golay-code keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a
23-bit word of the perfect binary Golay code (12 data bits, three correctable errors).
Two fingerprints with at most four differing bits fall under one of two cases:

* a segment is equal: the segment itself is a key;
* no segment is equal: then at least two segments differ in exactly one bit. If two words
  differ in one bit, the codeword nearest to one is among the codewords nearest to the
  words one bit around the other. So every fingerprint gives, for each pair of
  segments, all pairs of codeword indices found around its two words.

Rows with a common key meet in one task and are verified; keys with more members than
``BLOCK`` are cut into blocks and every pair of blocks becomes a task of its own. A task
returns a spanning forest of the links in its group, not all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.components import components
from stocktide.llm.text import narrow, over_batches, rows_back, text_key, texts, words_of
from stocktide.session import scratch_path, staged

SHINGLE = 4
SEED = 42
MOST_BITS = 4
WIDTHS = (22, 21, 21)
BLOCK = 2048
SMALL = 24  # groups up to this size are compared pair by pair
CHUNK = 1 << 16

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
LENGTH, CHECKS = 23, 11


def _remainder(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - CHECKS)), rest)
    return rest


def _error_table() -> np.ndarray:
    """Error pattern of each remainder; all patterns of up to three bits have their own."""
    patterns = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(LENGTH), n)]
    table = np.zeros(1 << CHECKS, np.int64)
    table[_remainder(np.array(patterns))] = patterns
    return table


_ERRORS = _error_table()


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (the 12 data bits) of the only codeword within three bits of each word."""
    return (words ^ _ERRORS[_remainder(words)]) >> CHECKS


def around(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct codeword indices nearest to the words up to one bit away, padded with -1."""
    flips = np.array([0, *(1 << b for b in range(width))], np.int64)
    found = np.sort(nearest(words[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    found = -np.sort(-found, axis=1)
    return found[:, : max(1, int((found >= 0).sum(axis=1).max()))]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of its fingerprint) for signed 64-bit fingerprints."""
    bits = prints.view(np.uint64)
    segments, shift = [], 0
    for width in WIDTHS:
        segments.append(((bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    every = np.arange(len(prints))
    keys = [(np.int64(i) << 24) | s for i, s in enumerate(segments)]
    owners = [every] * 3
    near = [around(s, w) for s, w in zip(segments, WIDTHS)]
    for kind, (i, j) in enumerate(combinations(range(3), 2), start=3):
        pair = (np.int64(kind) << 24) | (near[i][:, :, None] << 12) | near[j][:, None, :]
        valid = (near[i][:, :, None] >= 0) & (near[j][:, None, :] >= 0)
        keys.append(pair[valid])
        owners.append(np.nonzero(valid)[0])
    return np.concatenate(keys), np.concatenate(owners)


def fingerprint(text: bytes) -> int:
    """Unsigned fingerprint of a text; a text without words has fingerprint zero."""
    words = words_of(text.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    reach = min(SHINGLE, len(words)) - 1
    starts, ends = (ends - lengths)[: len(words) - reach], ends[reach:]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        cut = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in cut], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fp (signed) for every row, written once."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t) for t in texts(batch.column("text"))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(made)], names=["doc_id", "text_key", "fp"]
        )

    rows = narrow(docs).withColumn("text_key", text_key())
    return staged(over_batches(rows, work, "doc_id bigint, text_key bigint, fp bigint"), "fingerprints")


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; counted unsigned, as numpy counts the bits of a signed number's magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints, from the smallest outwards."""
    rest, found = np.sort(members), []
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            pivot = front.pop()
            hit = apart(rest, np.int64(pivot)) <= MOST_BITS
            if hit.any():
                reached = rest[hit].tolist()
                found.extend((pivot, other) for other in reached)
                front.extend(reached)
                rest = rest[~hit]
    return found


def _links_in(groups: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal group numbers."""
    edge = np.flatnonzero(np.diff(groups)) + 1
    starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(groups)]])
    sizes = ends - starts
    left, right = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    some, own = prints[small], groups[small]
    for lag in range(1, SMALL):
        same = own[lag:] == own[:-lag]
        if not same.any():
            break
        a, b = some[:-lag][same], some[lag:][same]
        near = (apart(a, b) <= MOST_BITS) & (a != b)
        left.append(np.minimum(a[near], b[near]))
        right.append(np.maximum(a[near], b[near]))
    for s, e in zip(starts[sizes > SMALL], ends[sizes > SMALL]):
        pairs = np.array(_forest(np.unique(prints[s:e])), np.int64).reshape(-1, 2)
        left.append(pairs.min(axis=1))
        right.append(pairs.max(axis=1))
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    both = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (grp, fp) of one partition, sorted by group; the last group of a batch waits for the next."""
    group, prints = np.empty(0, np.int64), np.empty(0, np.int64)

    def made(g: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
        a, b = _links_in(g, p)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        group = np.concatenate([group, batch.column("grp").to_numpy(zero_copy_only=False)])
        prints = np.concatenate([prints, batch.column("fp").to_numpy(zero_copy_only=False)])
        if len(group):
            cut = int(np.searchsorted(group, group[-1], "left"))
            if cut:
                yield made(group[:cut], prints[:cut])
                group, prints = group[cut:], prints[cut:]
    if len(group):
        yield made(group, prints)


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b), a < b, that join all fingerprints (``fp``, distinct) within ``MOST_BITS`` of each
    other; every link is covered by a path of returned links."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = batch.column("fp").to_numpy(zero_copy_only=False)
        keys, owners = keys_of(prints)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[owners])], names=["grp", "fp"])

    keyed = over_batches(distinct.select("fp"), work, "grp bigint, fp bigint")
    counts = keyed.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    counts = staged(counts, "golay-keys")
    large = counts.filter(F.col("n") > block)
    parts = [keyed.join(large, "grp", "left_anti").select("grp", "fp")]
    # a large key: blocks by hash; every pair of blocks is one cell with at most two blocks of rows
    blocks = F.ceil(F.col("n") / block).cast("int")
    cut = keyed.join(large, "grp").select(
        "grp", "fp", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    cells = cut.select(F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")).alias("grp"), "fp")
    if not large.isEmpty():
        parts.append(cells)
    found = [p.repartition("grp").sortWithinPartitions("grp").mapInArrow(_verified, "a bigint, b bigint") for p in parts]
    return staged(reduce(DataFrame.unionAll, found).distinct(), "golay-links")


def near_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, fp, component (its smallest fingerprint) and
    component_id (smallest doc_id reachable).

    Copies meet as one fingerprint before any key is made. Rows without words have
    fingerprint zero and are linked like any other. A null id has no place in
    ``component_id`` unless all ids of the component are null.
    """
    rows = fingerprints(docs)
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    groups = components(links(distinct, block)).withColumnRenamed("node", "fp")
    placed = distinct.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    heads = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = placed.join(heads, "component").select("fp", "component", "component_id")
    return rows.join(ids, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def kept_rows(docs: DataFrame, groups: Callable[[DataFrame], DataFrame] = near_groups) -> DataFrame:
    """One row of each component stays: the one with the smallest id, then the smallest text key."""
    path = scratch_path(docs.sparkSession, "near-groups")
    groups(docs).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    first = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    )
    return rows_back(docs, first.select("first.doc_id", "first.text_key"))


def query(docs: DataFrame) -> DataFrame:
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return near_groups(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")

"""Packing token sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut; full pieces are sequences of their own. The
other pieces are dealt into blocks of bounded size. Every block is evolved by several
islands, each one task: crossover injects whole well-filled bins of one parent into
the other, bins that hold a piece twice are emptied and the displaced pieces go where
they fit best. Between epochs the best solution of each island migrates to the next
one. The poorly filled bins of all blocks are dealt into fewer blocks and packed
again until one block is left.
"""

from __future__ import annotations

import os
import random
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.text import gathered, narrow, over_batches
from stocktide.session import staged

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
BLOCK = 4096  # pieces evolved together
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 5
WELL_FILLED = 0.98  # bins below are packed again in the next round
MOST_ROUNDS = 12
CACHED_PARTS = 400_000
SLICE_BYTES = 4 << 20  # text encoded at once
TOGETHER = 512  # parts of letters encoded as one text

# letters that have a lower case without context, then punctuation: pieces of their own for the tokenizer
_PARTS = r"^(?P<letters>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<marks>[.,!?;:%&$*#|]*)$"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer, which ids end a piece, and the ids of parts of words as they become known."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    ends = np.zeros(max(made.get_vocab().values()) + 1, bool)
    ends[[i for token, i in made.get_vocab().items() if token.endswith("</w>")]] = True
    return made, ends, {"": b""}


def _learn(tokenizer, ends: np.ndarray, known: dict[str, bytes], letters: list[str], others: list[str]) -> None:
    """Ids of parts not known yet. Parts of letters only are one piece each, so many are encoded as one text
    and told apart by the ids that end a piece."""
    together = [letters[at : at + TOGETHER] for at in range(0, len(letters), TOGETHER)]
    for own, found in zip(together, tokenizer.encode_batch_fast([" ".join(t) for t in together], add_special_tokens=False)):
        ids = np.array(found.ids, "<u4")
        cuts = (4 * (np.flatnonzero(ends[ids]) + 1)).tolist()
        if len(cuts) != len(own):
            others = others + own
            continue
        packed_ids = ids.tobytes()
        known.update((part, packed_ids[start:end]) for part, start, end in zip(own, [0, *cuts], cuts))
    for part, found in zip(others, tokenizer.encode_batch_fast(others, add_special_tokens=False)):
        known[part] = np.array(found.ids, "<u4").tobytes()


def _encode_slice(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    tokenizer, ends, known = _tokenizer(path)
    split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
    words = split.flatten().dictionary_encode()
    found = pc.extract_regex(words.dictionary, _PARTS)
    plain = found.is_valid()
    letters = pc.utf8_lower(found.field("letters").filter(plain)).dictionary_encode()
    marks = found.field("marks").filter(plain).dictionary_encode()
    whole = words.dictionary.filter(pc.invert(plain))
    own, rest = letters.dictionary.to_pylist(), marks.dictionary.to_pylist() + whole.to_pylist() + [""]
    if len(known) + len(own) + len(rest) > CACHED_PARTS:
        # what this slice has in common with earlier ones stays
        kept = {p: known[p] for p in own + rest if p in known}
        known.clear()
        known.update(kept)
    _learn(tokenizer, ends, known, [p for p in own if p not in known], [p for p in rest if p not in known])
    table = [known[p] for p in own + rest]
    # a word is its letters and its marks, or itself and nothing
    is_plain, nothing = plain.to_numpy(zero_copy_only=False), len(table) - 1
    halves = np.full((len(words.dictionary), 2), nothing)
    halves[is_plain, 0] = letters.indices.to_numpy()
    halves[is_plain, 1] = marks.indices.to_numpy() + len(own)
    halves[~is_plain, 0] = np.arange(len(whole)) + nothing - len(whole)
    sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
    values, sizes = gathered(np.frombuffer(b"".join(table), "<u4"), sizes, halves.ravel())
    ids, sizes = gathered(values, sizes.reshape(-1, 2).sum(1), words.indices.to_numpy())
    total = np.concatenate([[0], np.cumsum(sizes)])
    return ids, total[split.offsets.to_numpy() - split.offsets[0].as_py()]


def encode(column: pa.Array, path: str) -> Iterator[bytes]:
    """Ids of each text as little-endian 32-bit numbers. The tokenizer drops white space and no token, special
    ones included, spans it, so every different word of a slice of texts is looked up once, and its parts are remembered, up to a bound."""
    lengths = np.cumsum(pc.binary_length(column).to_numpy()) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(column)]
    for start, end in zip(cuts, cuts[1:]):
        # a copy of its own: kernels then see no offset into the batch
        ids, bounds = _encode_slice(pa.concat_arrays([column.slice(start, end - start)]), path)
        for first, last in zip(bounds.tolist(), bounds[1:].tolist()):
            yield ids[first:last].tobytes()


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Stored rows doc_id, uid, piece, start, length, ids_crc32 (and ids as array, if asked for)."""
    path = path or vocabulary_path()
    end = np.array([END_ID], "<u4").tobytes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {n: [] for n in ("doc_id", "uid", "piece", "start", "length", "ids_crc32", "ids")}
        keys = zip(batch.column("doc_id").to_pylist(), batch.column("uid").to_pylist())
        for (doc, uid), ids in zip(keys, encode(batch.column("text"), path)):
            ids += end
            for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                values = (doc, uid, number, at // 4, len(part) // 4, zlib.crc32(part))
                for column, value in zip(columns.values(), values):
                    column.append(value)
                if with_ids:
                    columns["ids"].append(np.frombuffer(part, "<u4").tolist())
        types = {"piece": pa.int32(), "ids": pa.list_(pa.int64())}
        named = {k: pa.array(v, types.get(k, pa.int64())) for k, v in columns.items() if k != "ids" or with_ids}
        return pa.RecordBatch.from_arrays(list(named.values()), names=list(named))

    schema = "doc_id bigint, uid bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    rows = narrow(docs).withColumn("uid", F.monotonically_increasing_id())
    return staged(over_batches(rows, work, schema + ", ids array<bigint>" * with_ids), "pieces")


class Bins:
    """Bins of pieces with best-fit placement: bins by free space, and a bit set of the spaces there are."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: dict[int, list[int]] = {}
        self.free: dict[int, int] = {}
        self.by_space: dict[int, list[int]] = {}
        self.spaces, self.next = 0, 0

    def _shelve(self, bin_: int, space: int) -> None:
        self.free[bin_] = space
        self.by_space.setdefault(space, []).append(bin_)
        self.spaces |= 1 << space

    def add_bin(self, pieces_: list[int]) -> None:
        self.bins[self.next] = list(pieces_)
        self._shelve(self.next, self.capacity - sum(self.sizes[i] for i in pieces_))
        self.next += 1

    def place(self, piece: int) -> None:
        size = self.sizes[piece]
        fitting = self.spaces >> size
        if not fitting:
            self.add_bin([piece])
            return
        space = size + (fitting & -fitting).bit_length() - 1
        shelf = self.by_space[space]
        bin_ = shelf.pop()
        if not shelf:
            self.spaces &= ~(1 << space)
        self.bins[bin_].append(piece)
        self._shelve(bin_, space - size)

    def place_all(self, pieces_: list[int]) -> None:
        for piece in sorted(pieces_, key=lambda i: -self.sizes[i]):
            self.place(piece)

    def groups(self) -> list[list[int]]:
        return list(self.bins.values())


def worth(groups: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones; smaller is better."""
    return len(groups), -sum((sum(sizes[i] for i in g) / capacity) ** 2 for g in groups)


def best_fit(sizes: list[int], capacity: int, noise: float, rng: random.Random) -> list[list[int]]:
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + noise * rng.random()))
    bins = Bins(sizes, capacity)
    for piece in order:
        bins.place(piece)
    return bins.groups()


def cross(mother: list[list[int]], father: list[list[int]], sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Well-filled bins of ``father`` go into ``mother`` whole; her bins that share a piece with them are
    emptied, as are a few of her worst bins, and what is displaced is placed by best fit."""
    filled = [g for g in father if sum(sizes[i] for i in g) >= WELL_FILLED * capacity]
    chosen = rng.sample(filled, max(1, len(filled) // 4)) if filled else []
    inside = {i for g in chosen for i in g}
    clear = [g for g in mother if inside.isdisjoint(g)]
    displaced = [i for g in mother if not inside.isdisjoint(g) for i in g if i not in inside]
    clear.sort(key=lambda g: -sum(sizes[i] for i in g))
    worst = max(1, len(clear) // 50) if clear else 0
    displaced += [i for g in clear[len(clear) - worst :] for i in g]
    bins = Bins(sizes, capacity)
    for group in chosen + clear[: len(clear) - worst]:
        bins.add_bin(group)
    bins.place_all(displaced)
    return bins.groups()


def evolve(sizes: list[int], capacity: int, elites: list[list[list[int]]], rng: random.Random) -> list[list[list[int]]]:
    """One epoch of one island: the population after it, best first. Ends early at the lower bound."""
    bound = -(-sum(sizes) // capacity)
    people = list(elites)
    while len(people) < POPULATION:
        people.append(best_fit(sizes, capacity, 0.0 if not people else 0.1, rng))
        if len(people[-1]) <= bound:
            break
    rank = lambda g: worth(g, sizes, capacity)
    people.sort(key=rank)
    for _ in range(GENERATIONS):
        if len(people[0]) <= bound or len(people) < 2:
            break
        children = []
        for _ in range(POPULATION):
            mother, father = rng.sample(people, 2)
            children.append(cross(mother, father, sizes, capacity, rng))
        people = sorted(people + children, key=rank)[:POPULATION]
    return people


def _groups_of(assigned: np.ndarray) -> list[list[int]]:
    order = np.argsort(assigned, kind="stable")
    cuts = np.flatnonzero(np.diff(assigned[order])) + 1
    return [g.tolist() for g in np.split(order, cuts)] if len(assigned) else []


def _assigned(groups: list[list[int]], n: int) -> list[int]:
    made = [0] * n
    for number, group in enumerate(groups):
        for i in group:
            made[i] = number
    return made


_ELITE = "block bigint, island int, bins int, fitness double, assigned array<int>"


def _epoch(dealt: DataFrame, elites: DataFrame | None, epoch: int, capacity: int) -> DataFrame:
    """The best solution of each (block, island)."""

    def work(key: tuple, items: pd.DataFrame, incoming: pd.DataFrame | None) -> pd.DataFrame:
        block, island = key
        items = items.sort_values("pid")
        sizes = items["length"].tolist()
        if not sizes:
            return pd.DataFrame({"block": [], "island": [], "bins": [], "fitness": [], "assigned": []})
        elite = [] if incoming is None else [_groups_of(np.asarray(a)) for a in incoming["assigned"]]
        rng = random.Random(f"{block}/{island}/{epoch}")
        best = evolve(sizes, capacity, elite, rng)[0]
        bins, fitness = worth(best, sizes, capacity)
        return pd.DataFrame(
            {"block": [block], "island": [island], "bins": [bins], "fitness": [fitness], "assigned": [_assigned(best, len(sizes))]}
        )

    keys = ["block", "island"]
    if elites is None:
        return dealt.groupBy(*keys).applyInPandas(lambda key, items: work(key, items, None), _ELITE)
    return dealt.groupBy(*keys).cogroup(elites.groupBy(*keys)).applyInPandas(work, _ELITE)


def _placed(items: DataFrame, best: DataFrame) -> DataFrame:
    """Bin and fill of each piece from the best solution of its block."""

    def work(key: tuple, items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        if items.empty:
            return pd.DataFrame({"pid": [], "length": [], "block": [], "bin": [], "fill": []})
        items = items.sort_values("pid").reset_index(drop=True)
        items["bin"] = np.asarray(best["assigned"].iloc[0])
        items["fill"] = items.groupby("bin")["length"].transform("sum")
        return items[["pid", "length", "block", "bin", "fill"]]

    schema = "pid bigint, length bigint, block bigint, bin int, fill bigint"
    return items.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(work, schema)


def evolve_blocks(items: DataFrame, block: int, capacity: int, seed: int) -> tuple[DataFrame, int]:
    """Stored rows pid, length, block, bin, fill for ``items`` (pid, length); and the number of blocks."""
    blocks = max(1, -(-items.count() // block))
    dealt = items.select("pid", "length", F.pmod(F.xxhash64(F.lit(seed), "pid"), F.lit(blocks)).alias("block"))
    on_islands = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    elites = None
    for epoch in range(EPOCHS):
        found = staged(_epoch(on_islands, elites, epoch, capacity), "islands")
        # migration: an island keeps its best solution and gets its neighbour's
        moved = found.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int"))
        elites = found.unionByName(moved)
    best = found.groupBy("block").agg(F.min(F.struct("bins", "fitness", "island", "assigned")).alias("best"))
    best = best.select("block", F.col("best.assigned").alias("assigned"))
    return staged(_placed(dealt, best), "packed"), blocks


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``items`` (pid unique, length from 1 to ``capacity``; a stored table) with ``sequence_id`` and ``offset``."""
    full = items.filter(F.col("length") == capacity).select(
        "pid", (-F.col("pid") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    left, done = items.filter(F.col("length") < capacity).select("pid", "length"), [full]
    for number in range(MOST_ROUNDS):
        placed, blocks = evolve_blocks(left, block, capacity, number)
        last = blocks == 1 or number == MOST_ROUNDS - 1
        ready = placed if last else placed.filter(F.col("fill") >= WELL_FILLED * capacity)
        sequence = F.lit(number << 56) + F.shiftleft("block", 16) + F.col("bin")
        done.append(_offsets(ready.withColumn("sequence_id", sequence)))
        if last:
            break
        left = placed.filter(F.col("fill") < WELL_FILLED * capacity).select("pid", "length")
    made = done[0]
    for more in done[1:]:
        made = made.unionByName(more)
    return made


def _offsets(rows: DataFrame) -> DataFrame:
    """Running starts inside each sequence; a sequence holds at most ``capacity`` pieces."""
    gathered = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("pid", "length"))).alias("own"))
    starts = F.transform(
        "own",
        lambda x, i: F.struct(
            x["pid"].alias("pid"),
            F.aggregate(F.slice("own", F.lit(1), i), F.lit(0).cast("bigint"), lambda acc, y: acc + y["length"]).alias("offset"),
        ),
    )
    return gathered.select("sequence_id", F.explode(starts).alias("at")).select("at.pid", "sequence_id", "at.offset")


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Repeated rows are packed as often as they
    occur. An empty table gives no rows.
    """
    made = staged(pieces(docs, path, capacity).withColumn("pid", F.monotonically_increasing_id()), "numbered-pieces")
    placed = pack(made.select("pid", "length"), capacity, block)
    return made.join(placed, "pid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def query(docs: DataFrame) -> DataFrame:
    return packed(docs)

"""Substring deduplication: matching statistics against suffix automata of reference shards.

A window of ``WINDOW`` words is removed where its word sequence starts in a document with a
smaller id. Only text that may repeat is looked at:

1. Every window has an anchor, the least hash of its ``GRAM``-word sequences; equal windows
   have equal anchors. Runs of windows with one anchor are one row. Anchors found in
   one document only are dropped.
2. A run whose whole text also occurs in a smaller document refers to the smallest such
   document. All other runs are looked up window by window, and refer to the first
   document that has the window. (Hashes only decide what meets whom.)
3. What is referred to in first documents are the references. They are dealt into shards of a
   bounded number of words, and each shard becomes a suffix automaton of words in the
   tasks of that shard; what refers to it streams past. A state keeps the smallest
   document its text ends in, so a match of ``WINDOW`` words that started in a smaller
   document is seen exactly, word by word.

A shard that many documents refer to is copied to several tasks, each with a part of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.text import narrow, over_batches, text_key, texts, words_of
from stocktide.session import staged

WINDOW = 50
GRAM = 10
SHARD_WORDS = 40_000  # reference words in one automaton
TASK_WORDS = 400_000  # words that stream past one copy of it
KNOWN_WORDS = 400_000
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they can be inverted modulo 2^64


class _Hashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word)
        return made


_hashes = _Hashes()


def _powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    made[:1] = 1
    return np.multiply.accumulate(made)


class Rolling:
    """Hash of any word range of a text from prefix sums modulo 2^64."""

    def __init__(self, words: list[bytes]):
        codes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
        self.sums, self.back = [], []
        for base in BASES:
            up = _powers(base, len(words))
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up, dtype=np.uint64)]))
            self.back.append(_powers(pow(base, -1, 1 << 64), len(words) + 1))

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        mixed = (self.sums[which][end] - self.sums[which][start]) * self.back[which][start]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    reach = 1
    while 2 * reach <= width:
        values, reach = np.minimum(values[:-reach], values[reach:]), 2 * reach
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :])


def runs_of(words: list[bytes]) -> tuple[np.ndarray, ...]:
    """anchor, first and last window start, and two hashes of the text of each run of windows."""
    rolling = Rolling(words)
    grams = np.arange(len(words) - GRAM + 1)
    anchors = _least(rolling.of(grams, grams + GRAM), WINDOW - GRAM + 1)
    cut = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    low, high = np.concatenate([[0], cut]), np.concatenate([cut, [len(anchors)]]) - 1
    return anchors[low], low, high, rolling.of(low, high + WINDOW), rolling.of(low, high + WINDOW, 1)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted half-open ranges without overlap."""
    made: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if made and start <= made[-1][1]:
            made[-1] = (made[-1][0], max(end, made[-1][1]))
        else:
            made.append((start, end))
    return made


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _short(values: np.ndarray) -> pa.Array:
    return pa.array((values >> np.uint64(32)).astype(np.uint32).view(np.int32))


def anchored(docs: DataFrame) -> DataFrame:
    """Stored rows: key (doc_id, text_key), anchor, low, high, c1, c2. Rows without an id have no
    place in the order of documents and take no part."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts, rows = [], []
        for i, text in enumerate(texts(batch.column("text"))):
            words = words_of(text)
            if len(words) >= WINDOW:
                parts.append(runs_of(words))
                rows.append(np.full(len(parts[-1][0]), i))
        if not parts:
            return None
        anchor, low, high, c1, c2 = map(np.concatenate, zip(*parts))
        row = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(row), batch.column("text_key").take(row), _signed(anchor),
                pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), _signed(c1), _short(c2),
            ],
            names=["doc_id", "text_key", "anchor", "low", "high", "c1", "c2"],
        )

    rows = narrow(docs).filter("doc_id is not null").withColumn("text_key", text_key())
    schema = "doc_id bigint, text_key bigint, anchor bigint, low int, high int, c1 bigint, c2 int"
    return staged(over_batches(rows, work, schema), "anchors")


def candidates(runs: DataFrame) -> DataFrame:
    """Stored runs whose anchor occurs in several documents, with ``first``, the smallest document that
    has the whole run."""
    shared = (
        runs.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most").select("anchor")
    )
    found = staged(runs.join(shared, "anchor", "left_semi"), "shared-anchors")
    whole = found.groupBy("c1", "c2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("most"))
    asked = (F.col("first") < F.col("most")).alias("asked")  # other documents refer to the first one
    return staged(found.join(whole, ["c1", "c2"]).select("doc_id", "text_key", "low", "high", "first", asked), "runs")


def _cut(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Stored rows (doc_id, text_key, starts, bodies): the text under the ranges of each document, and
    ``settled`` (low, high, first) as it came."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, bodies = [], []
        for text, own in zip(texts(batch.column("text")), batch.column("ranges").to_pylist()):
            words = words_of(text)
            parts = _merged([(r["low"], r["high"] + WINDOW) for r in own])
            starts.append([s for s, _ in parts])
            bodies.append([b" ".join(words[s:e]) for s, e in parts])
        kept = ["doc_id", "text_key", "ranges"]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(starts, pa.list_(pa.int32())), pa.array(bodies, pa.list_(pa.binary()))],
            names=[*kept, "starts", "bodies"],
        )

    ranges = ranges.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("low", "high", "first", "asked")).alias("ranges"))
    rows = narrow(docs).withColumn("text_key", text_key()).join(ranges, ["doc_id", "text_key"])
    schema = (
        "doc_id bigint, text_key bigint, ranges array<struct<low:int,high:int,first:bigint,asked:boolean>>, starts array<int>, bodies array<binary>"
    )
    # rows that repeat id and text have the same windows
    return staged(over_batches(rows, work, schema).dropDuplicates(["doc_id", "text_key"]), "segments")


def _windows(segments: DataFrame) -> DataFrame:
    """doc_id, text_key, at, w1, w2 for the windows of runs that are first of their kind."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = []
        columns = [batch.column(n).to_pylist() for n in ("ranges", "starts", "bodies")]
        for i, (ranges, starts, bodies) in enumerate(zip(*columns)):
            doc = batch.column("doc_id")[i].as_py()
            own = _merged([(r["low"], r["high"] + 1) for r in ranges if r["first"] == doc])
            for start, body in zip(starts, bodies):
                words = words_of(body)
                last = start + len(words) - WINDOW
                inside = [np.arange(max(s, start), min(e, last + 1)) for s, e in own if s <= last and e > start]
                if inside:
                    at = np.concatenate(inside)
                    rolling, local = Rolling(words), at - start
                    parts.append((np.full(len(at), i), at, rolling.of(local, local + WINDOW), rolling.of(local, local + WINDOW, 1)))
        if not parts:
            return None
        row, at, w1, w2 = map(np.concatenate, zip(*parts))
        row = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(row), batch.column("text_key").take(row), pa.array(at.astype(np.int32)), _signed(w1), _short(w2)],
            names=["doc_id", "text_key", "at", "w1", "w2"],
        )

    rows = segments.filter(F.exists("ranges", lambda r: r["first"] == F.col("doc_id")))
    return over_batches(rows, work, "doc_id bigint, text_key bigint, at int, w1 bigint, w2 int")


def _references(segments: DataFrame) -> DataFrame:
    """Which first document each repeated window refers to: doc_id, text_key, refers (at, first)."""
    windows = staged(_windows(segments), "windows")
    repeated = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"))
    return windows.join(repeated, ["w1", "w2"]).groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("at", "first")).alias("refers")
    )


def _spans(segments: DataFrame, refers: DataFrame) -> DataFrame:
    """Stored rows (first, doc_id, text_key, start, body, n): stretches whose windows refer to ``first``; where
    that is the document itself, the stretch is a reference."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = {n: [] for n in ("first", "doc_id", "text_key", "start", "body", "n")}
        names = ("doc_id", "text_key", "ranges", "starts", "bodies", "refers")
        for doc, key, ranges, starts, bodies, refers in zip(*(batch.column(n).to_pylist() for n in names)):
            by_first: dict[int, list] = {}
            for r in ranges:
                if r["first"] < doc or r["asked"]:
                    by_first.setdefault(r["first"], []).append((r["low"], r["high"] + WINDOW))
            for r in refers or ():
                by_first.setdefault(r["first"], []).append((r["at"], r["at"] + WINDOW))
            if not by_first:
                continue
            words = [words_of(b) for b in bodies]
            for first, own in by_first.items():
                # neighbouring windows only: touching stretches would add windows nobody asked for
                for start, end in _stretches(own):
                    part = np.searchsorted(starts, start, "right") - 1
                    cut = words[part][start - starts[part] : end - starts[part]]
                    for column, value in zip(made.values(), (first, doc, key, start, b" ".join(cut), len(cut))):
                        column.append(value)
        types = {"start": pa.int32(), "n": pa.int32(), "body": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in made.items()], names=list(made))

    rows = segments.join(refers, ["doc_id", "text_key"], "left")
    return staged(over_batches(rows, work, "first bigint, doc_id bigint, text_key bigint, start int, body binary, n int"), "spans")


def _stretches(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges joined where the next one starts at most one word after the last window's start."""
    made: list[tuple[int, int]] = []
    for start, end in sorted(windows):
        if made and start <= made[-1][1] - WINDOW + 1:
            made[-1] = (made[-1][0], max(end, made[-1][1]))
        else:
            made.append((start, end))
    return made


class Automaton:
    """Suffix automaton over words; every state knows the smallest document one of its ends lies in."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def add(self, words: list[bytes], doc: int) -> None:
        """One reference text. The walk starts at the root again, so no match crosses two texts."""
        last = 0
        for word in words:
            last = self._extend(last, word)
            if self.least[last] is None or doc < self.least[last]:
                self.least[last] = doc

    def _extend(self, last: int, word: bytes) -> int:
        step, link, length = self.next, self.link, self.length
        if word in step[last]:
            there = step[last][word]
            return there if length[there] == length[last] + 1 else self._split(last, there, word)
        new = self._state({}, 0, length[last] + 1)
        while last >= 0 and word not in step[last]:
            step[last][word] = new
            last = link[last]
        if last >= 0:
            there = step[last][word]
            link[new] = there if length[there] == length[last] + 1 else self._split(last, there, word)
        return new

    def _state(self, edges: dict, link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.least.append(None)
        return len(self.link) - 1

    def _split(self, last: int, there: int, word: bytes) -> int:
        copy = self._state(dict(self.next[there]), self.link[there], self.length[last] + 1)
        self.link[there] = copy
        while last >= 0 and self.next[last].get(word) == there:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def finish(self) -> None:
        """Smallest documents flow from long states to the suffixes of their texts."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            own, up = self.least[state], self.link[state]
            if own is not None and (self.least[up] is None or own < self.least[up]):
                self.least[up] = own

    def matches(self, words: list[bytes], before: int, window: int = WINDOW) -> Iterator[int]:
        """Starts of the windows that also lie in a document before ``before``, from the length of the longest
        match that ends at each word."""
        step, link, length, least = self.next, self.link, self.length, self.least
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state, matched = step[state][word], matched + 1
            while state and length[link[state]] >= window:  # the state of the last ``window`` words
                state = link[state]
                matched = length[state]
            if matched >= window and least[state] < before:
                yield i - window + 1


def _verify(references: pa.Table, asking: pa.Table) -> pa.Table:
    made = {"doc_id": [], "text_key": [], "low": [], "high": []}
    if references.num_rows and asking.num_rows:
        automaton = Automaton()
        for body, doc in zip(references.column("ref_body").to_pylist(), references.column("ref_doc_id").to_pylist()):
            automaton.add(words_of(body), doc)
        automaton.finish()
        columns = [asking.column(n).to_pylist() for n in ("doc_id", "text_key", "start", "body")]
        for doc, key, start, body in zip(*columns):
            found = [(start + at, start + at + WINDOW) for at in automaton.matches(words_of(body), doc)]
            for low, high in _merged(found):
                for column, value in zip(made.values(), (doc, key, low, high)):
                    column.append(value)
    types = {"low": pa.int32(), "high": pa.int32()}
    return pa.table({k: pa.array(v, types.get(k, pa.int64())) for k, v in made.items()})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, low, high: word ranges that repeat text of smaller documents; they may overlap."""
    runs = candidates(anchored(docs))
    segments = _cut(docs, runs)
    spans = _spans(segments, _references(segments))
    is_reference = F.col("doc_id") == F.col("first")
    totals = spans.agg(F.sum(F.when(is_reference, F.col("n")))).first()[0] or 0
    shards = max(1, -(-totals // SHARD_WORDS))
    spans = spans.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)))
    load = spans.filter(~is_reference).groupBy("shard").agg(F.ceil(F.sum("n") / TASK_WORDS).cast("int").alias("copies"))
    load = staged(load, "shard-copies")  # one row per shard
    asking = spans.filter(~is_reference).join(load, "shard").withColumn(
        "copy", F.pmod(F.xxhash64("doc_id", "text_key", "start"), F.col("copies")).cast("int")
    )
    references = spans.filter(is_reference).join(load, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    references = references.select(*(F.col(c).alias(f"ref_{c}") for c in ("shard", "copy", "body", "doc_id")))
    return references.groupBy("ref_shard", "ref_copy").cogroup(asking.groupBy("shard", "copy")).applyInArrow(
        _verify, "doc_id bigint, text_key bigint, low int, high int"
    )


def clean(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space) for every row of ``docs``.

    Judged on the input, not on what is left. A null or empty text has no words. Rows with
    one id do not remove from each other; a row without an id stays whole.
    """
    found = repeated_spans(docs).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, removed, kept = [], [], []
        for text, spans in zip(texts(batch.column("text")), batch.column("spans").to_pylist()):
            words, left, at = words_of(text), [], 0
            for low, high in _merged([(s["low"], s["high"]) for s in spans or ()]):
                left += words[at:low]
                at = high
            left += words[at:]
            counts.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )

    rows = narrow(docs).withColumn("text_key", text_key()).join(found, ["doc_id", "text_key"], "left")
    return over_batches(rows, work, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def query(docs: DataFrame) -> DataFrame:
    return clean(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

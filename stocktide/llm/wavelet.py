"""Token ids in wavelet matrices, one compressed file for each shard.

A shard holds the ids of consecutive documents, each with an end id behind it. Its file is one
wavelet matrix: the ids are cut into bit planes, highest first, and after each plane the ids with a
zero there come before those with a one. Planes are cut into chunks of ``CHUNK`` bits, compressed
one by one, and the header holds the number of ones before each chunk. So access to a token,
counting a token and finding its places read the header and a few chunks, never the whole file.

File: magic, length of the header, header (int64 numbers, zstandard): tokens, documents, planes, chunk
bits, bytes of the document section; zeros of each plane; offset, length and ones before for every
chunk. Then the document section (zstandard: lengths, id present, ids) and the chunks.

Documents go by ascending id (null first), then by text; rows with the same id and text are separate
documents. Nulls count as empty texts, which hold the end id only. A shard ends with the document
that reaches ``SHARD_TOKENS``, so only a document longer than that makes a larger one. Range partitions
over id, text and row number deal rows out, so a repeated row is split as well. Other columns are left
out, so their names cannot clash. An empty table gives no files and an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.text import narrow, slices, text_key
from stocktide.llm.tokens import encoded
from stocktide.operators.ordered import running_total
from stocktide.session import scratch_path, staged

MAGIC = b"WAVELET1"
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 1 << 23
CHUNK = 1 << 18  # bits
HELD_CHUNKS = 64
ROWS = 1 << 12  # documents of a batch that is read back

_MANIFEST = "part int, shard int, path string, documents bigint, tokens bigint, bytes bigint"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _store(folder: str):
    """The file system of a folder all executors reach, and the folder's path in it."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


# ---- the file -----------------------------------------------------------------------------------


def packed(ids: np.ndarray, lengths: list[int], doc_ids: list[int | None]) -> bytes:
    """The file of a shard."""
    press = zstandard.ZstdCompressor(level=1)
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    current = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, index, bodies = [], [], []
    given = [doc is not None for doc in doc_ids]
    section = press.compress(
        np.array(lengths, "<i8").tobytes() + np.array(given, np.uint8).tobytes()
        + np.array([doc or 0 for doc in doc_ids], "<i8").tobytes()
    )
    offset = len(section)
    for plane in range(planes - 1, -1, -1):
        ones = (current >> plane) & 1 != 0
        before = 0
        for at in range(0, len(ones), CHUNK):
            bits = ones[at : at + CHUNK]
            body = press.compress(np.packbits(bits, bitorder="little").tobytes())
            index.append((offset, len(body), before))
            bodies.append(body)
            offset, before = offset + len(body), before + int(np.count_nonzero(bits))
        zeros.append(len(ones) - before)
        current = np.concatenate([current[~ones], current[ones]])
    numbers = [len(ids), len(lengths), planes, CHUNK, len(section), *zeros, *(n for row in index for n in row)]
    header = press.compress(np.array(numbers, "<i8").tobytes())
    return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, section, *bodies])


class Chunk:
    """Bits of a plane with their ranks, a word of 64 bits at a time."""

    def __init__(self, body: bytes, bits: int):
        self.bytes = np.frombuffer(body, np.uint8)
        whole = np.zeros(-(-bits // 64) * 8, np.uint8)
        whole[: len(self.bytes)] = self.bytes
        self.words = whole.view("<u8")
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        words = self.words[np.minimum(at >> 6, len(self.words) - 1)] if len(self.words) else np.zeros(len(at), np.uint64)
        return self.ranks[at >> 6] + np.bitwise_count(words & inside)


class WaveletFile:
    """A shard read through ``read(offset, length)``, only as far as it is asked for."""

    def __init__(self, read):
        self.read = read
        start = read(0, 16)
        if start[:8] != MAGIC:
            raise ValueError("not a wavelet file")
        size = int.from_bytes(start[8:], "little")
        unpress = self.unpress = zstandard.ZstdDecompressor()
        numbers = np.frombuffer(unpress.decompress(read(16, size)), "<i8")
        self.tokens, self.documents, self.planes, self.chunk, self.section = numbers[:5].tolist()
        self.zeros = numbers[5 : 5 + self.planes].tolist()
        self.per_plane = -(-self.tokens // self.chunk)
        self.index = numbers[5 + self.planes :].reshape(self.planes, self.per_plane, 3)
        self.body = 16 + size
        self.chunks = lru_cache(HELD_CHUNKS)(self._chunk)

    @classmethod
    def open(cls, path: str) -> WaveletFile:
        store, inner = _store(path)
        source = store.open_input_file(inner)

        def read(offset: int, length: int) -> bytes:
            source.seek(offset)
            return source.read(length)

        return cls(read)

    def _bytes(self, plane: int, number: int) -> bytes:
        offset, length, _ = self.index[plane, number].tolist()
        return self.unpress.decompress(self.read(self.body + offset, length))

    def _chunk(self, plane: int, number: int) -> Chunk:
        return Chunk(self._bytes(plane, number), min(self.chunk, self.tokens - number * self.chunk))

    def _by_chunk(self, plane: int, at: np.ndarray, ask) -> np.ndarray:
        made = np.zeros(len(at), np.int64)
        numbers = np.minimum(at // self.chunk, max(0, self.per_plane - 1))
        for number in np.unique(numbers).tolist():
            own = numbers == number
            made[own] = ask(self.chunks(plane, number), at[own] - number * self.chunk, int(self.index[plane, number, 2]))
        return made

    def _rank(self, plane: int, at: np.ndarray) -> np.ndarray:
        return self._by_chunk(plane, at, lambda chunk, inside, before: before + chunk.rank(inside))

    def _bits(self, plane: int, at: np.ndarray) -> np.ndarray:
        return self._by_chunk(plane, at, lambda chunk, inside, before: chunk.bit(inside)) != 0

    def _select(self, plane: int, nth: np.ndarray, one: bool) -> np.ndarray:
        """Where the bits number ``nth`` (from 0) of one kind are."""
        before = self.index[plane, :, 2]
        if not one:
            before = np.arange(self.per_plane) * self.chunk - before
        numbers = np.searchsorted(before, nth, "right") - 1
        made = np.zeros(len(nth), np.int64)
        for number in np.unique(numbers).tolist():
            own, chunk = numbers == number, self.chunks(plane, number)
            ranks = chunk.ranks if one else np.arange(len(chunk.ranks)) * 64 - chunk.ranks
            left = nth[own] - before[number]
            word = np.searchsorted(ranks, left, "right") - 1
            bits = np.unpackbits(chunk.words[word].view(np.uint8).reshape(len(word), 8), axis=1, bitorder="little")
            seen = np.cumsum(bits == one, axis=1, dtype=np.int64)
            inside = np.argmax(seen > (left - ranks[word])[:, None], axis=1)
            made[own] = number * self.chunk + word * 64 + inside
        return made

    def access(self, places) -> np.ndarray:
        """The tokens at some places."""
        at = np.asarray(places, np.int64)
        made = np.zeros(len(at), np.int64)
        for plane in range(self.planes):
            ones, ranks = self._bits(plane, at), self._rank(plane, at)
            made = made << 1 | ones
            at = np.where(ones, self.zeros[plane] + ranks, at - ranks)
        return made

    def _range(self, token: int, first: int, last: int) -> tuple[int, int]:
        """Where copies of a token between two places end up below the last plane."""
        if token < 0 or token >> self.planes or first >= last:
            return 0, 0
        ends = np.array([first, last], np.int64)
        for plane in range(self.planes):
            ranks = self._rank(plane, ends)
            ends = self.zeros[plane] + ranks if token >> (self.planes - 1 - plane) & 1 else ends - ranks
        return int(ends[0]), int(ends[1])

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        start, end = self._range(token, first, self.tokens if last is None else last)
        return end - start

    def places(self, token: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ascending places of a token."""
        start, end = self._range(token, first, self.tokens if last is None else last)
        at = np.arange(start, end, dtype=np.int64)
        for plane in range(self.planes - 1, -1, -1):
            one = bool(token >> (self.planes - 1 - plane) & 1)
            at = self._select(plane, at - self.zeros[plane] if one else at, one)
        return at

    def all_tokens(self) -> np.ndarray:
        """All tokens in order, from the lowest plane up."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        current = np.zeros(self.tokens, kind)
        for plane in range(self.planes - 1, -1, -1):
            raw = b"".join(self._bytes(plane, number) for number in range(self.per_plane))
            ones = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.tokens, bitorder="little").view(bool)
            made = np.empty(self.tokens, kind)
            made[~ones] = current[: self.zeros[plane]]
            made[ones] = current[self.zeros[plane] :] | kind(1 << (self.planes - 1 - plane))
            current = made
        return current.astype("<u4")

    def documents_held(self) -> tuple[np.ndarray, list[int | None]]:
        """Lengths and ids of the documents."""
        raw, n = self.unpress.decompress(self.read(self.body, self.section)), self.documents
        given = np.frombuffer(raw[8 * n : 9 * n], np.uint8)
        ids = [doc if there else None for doc, there in zip(np.frombuffer(raw[9 * n :], "<i8").tolist(), given)]
        return np.frombuffer(raw[: 8 * n], "<i8"), ids


# ---- many files ---------------------------------------------------------------------------------


def _put(folder: str, name: str, body: bytes) -> str:
    """A file written beside its place and moved there, so an attempt that dies leaves none behind under its name."""
    store, inner = _store(folder)
    store.create_dir(inner, recursive=True)
    beside = f"{inner}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(beside) as out:
        out.write(body)
    store.move(beside, f"{inner}/{name}")
    return f"{folder}/{name}"


def written(
    docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Files of all documents below ``folder`` (a new one in the shared folder), and a stored row for each:
    part, shard, path, documents, tokens, bytes. Parts and the shards of a part go by document order."""
    path = path or vocabulary_path()
    folder = folder or scratch_path(docs.sparkSession, "wavelet")
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        bodies, lengths, doc_ids, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            body = packed(np.frombuffer(b"".join(bodies), "<u4"), lengths, doc_ids)
            place = _put(folder, f"shard-{part:06d}-{shard:06d}.wm", body)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "shard": shard, "path": place, "documents": len(lengths), "tokens": held, "bytes": len(body)}],
                pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]),
            )

        for batch in batches:
            for some in slices(batch, most=8 << 20, rows=1 << 16):
                for doc, ids in zip(some.column("doc_id").to_pylist(), encoded(some.column("text"), path)):
                    bodies.append(ids + end)
                    lengths.append(len(ids) // 4 + 1)
                    doc_ids.append(doc)
                    held += lengths[-1]
                    if held >= shard_tokens:
                        yield closed()
                        shard += 1
                        bodies, lengths, doc_ids, held = [], [], [], 0
        if lengths:
            yield closed()

    order = ["doc_id", "text_key", "uid"]
    rows = narrow(docs).withColumns({"text_key": text_key(), "uid": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return staged(ranged.mapInArrow(work, _MANIFEST), "wavelet-manifest")


def _each_file(manifest: DataFrame, columns: list[str]) -> DataFrame:
    """One file after the other over all cores; rows are too small for Spark to spread them by size."""
    spark = manifest.sparkSession
    return manifest.select(*columns).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")


def read_back(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian 32-bit) of every document, from the files."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                file = WaveletFile.open(place)
                ids = file.all_tokens()
                lengths, doc_ids = file.documents_held()
                ends = np.cumsum(lengths)
                for at in range(0, len(lengths), ROWS):
                    stop = min(at + ROWS, len(lengths))
                    starts = (ends - lengths)[at:stop]
                    bodies = [ids[s:e].tobytes() for s, e in zip(starts.tolist(), ends[at:stop].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[at:stop], pa.int64()), pa.array(starts + start), pa.array(lengths[at:stop]), pa.array(bodies, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    starts = running_total(manifest, [F.col("part"), F.col("shard")], "tokens", "through")
    placed = _each_file(starts.withColumn("start", F.col("through") - F.col("tokens")), ["path", "start"])
    return placed.mapInArrow(work, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def occurrences(manifest: DataFrame, token: int) -> DataFrame:
    """path, doc_id, place (in its document, from 0) of every copy of a token; reads only the chunks that lead there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column("path").to_pylist():
                file = WaveletFile.open(place)
                at = file.places(token)
                lengths, doc_ids = file.documents_held()
                ends = np.cumsum(lengths)
                own = np.searchsorted(ends, at, "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place] * len(at), pa.string()), pa.array([doc_ids[i] for i in own.tolist()], pa.int64()), pa.array(at - (ends - lengths)[own])],
                    names=["path", "doc_id", "place"],
                )

    return _each_file(manifest, ["path"]).mapInArrow(work, "path string, doc_id bigint, place bigint")


def counted(manifest: DataFrame, token: int) -> DataFrame:
    """path and number of copies of a token, by rank alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [WaveletFile.open(place).count(token) for place in paths]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.int64())], names=["path", "copies"])

    return _each_file(manifest, ["path"]).mapInArrow(work, "path string, copies bigint")


def query(docs: DataFrame) -> DataFrame:
    """CRC-32 of the ids of each document as its file gives them back."""
    return read_back(written(docs)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

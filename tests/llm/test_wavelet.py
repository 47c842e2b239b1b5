"""Token files: the structure against plain lists, the files against the tokenizer."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stocktide.llm import wavelet
from stocktide.llm.tokens import Encoder

tokenizers = pytest.importorskip("tokenizers")
SCHEMA = "doc_id bigint, text string, path string, tokens string, start string, uid string"


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(wavelet.vocabulary_path())


@pytest.mark.parametrize("chunk", [64, 1 << 18])
@pytest.mark.parametrize("most", [1, 2, 7, 50_000, 70_000])
def test_rank_select_and_access(monkeypatch, chunk, most):
    monkeypatch.setattr(wavelet, "CHUNK", chunk)
    rng = np.random.default_rng(most)
    ids = np.concatenate([rng.integers(0, most, 700), np.full(300, most - 1), rng.integers(0, most, 37)]).astype(np.uint32)
    body = wavelet.packed(ids, [1000, 37], [5, None])
    file = wavelet.WaveletFile(lambda offset, length: body[offset : offset + length])
    assert file.all_tokens().tolist() == ids.tolist()
    assert file.access(range(len(ids))).tolist() == ids.tolist() and file.access([]).tolist() == []
    for token in {*ids[:20].tolist(), 0, most - 1, most, most * 4, -1}:
        assert file.places(token).tolist() == np.flatnonzero(ids == token).tolist()
        for first, last in ((0, 1037), (3, 700), (64, 128), (5, 5), (1036, 1037)):
            assert file.count(token, first, last) == int(np.count_nonzero(ids[first:last] == token))
    assert file.documents_held()[0].tolist() == [1000, 37] and file.documents_held()[1] == [5, None]


def test_lookups_read_a_small_part():
    ids = np.random.default_rng(1).integers(0, 50_000, 2_000_000).astype(np.uint32)
    body = wavelet.packed(ids, [len(ids)], [1])
    seen = []
    file = wavelet.WaveletFile(lambda offset, length: seen.append(length) or body[offset : offset + length])
    assert file.access([1_234_567])[0] == ids[1_234_567]
    assert sum(seen) < len(body) / 4


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(4)
    parts = [
        " ", " ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", "​", "a", "The", "é", "É", ".", ",", "!", "'s", "'", "12",
        "日本", "<|endoftext|>", "ǅ", "ª", "_", "-", "́", "x", "|", '"', "\U0001f600", "ﬁ", "ا",
    ]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(6000)] + ["", "a\0 b", "word " * 3000]
    encoder = Encoder(wavelet.vocabulary_path())
    got = list(encoder.encode(pa.array(made, pa.string())))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [e.ids for e in tokenizer.encode_batch(made, add_special_tokens=False)]


def _expected(rows, tokenizer):
    start, made = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        made.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return made


@pytest.mark.parametrize("shard_tokens", [50, wavelet.SHARD_TOKENS])
def test_files_give_the_ids_back(spark, tokenizer, tmp_path, shard_tokens):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["The", "word", "is", "1984", "café", "\n"]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (None, "no id"), (102, "long " * 60_000), (103, "a <|endoftext|> b")] + [(104, "one row many times")] * 60
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(4)
    manifest = wavelet.written(docs, str(tmp_path / "files"), shard_tokens=shard_tokens)
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in wavelet.read_back(manifest).collect()]
    assert sorted(got, key=lambda r: r[1]) == _expected(rows, tokenizer)
    token = tokenizer.encode(" word").ids[0]
    want = sorted(
        (doc, at) for doc, text in rows for at, found in enumerate(tokenizer.encode(text or "").ids) if found == token
    )
    assert sorted((r["doc_id"], r["place"]) for r in wavelet.occurrences(manifest, token).collect()) == want
    assert sum(r["copies"] for r in wavelet.counted(manifest, token).collect()) == len(want)
    assert not [p for p in (tmp_path / "files").iterdir() if p.name.startswith(".shard") and not p.name.endswith(".crc")]


def test_query_on_the_tables(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(tuple(r) for r in wavelet.query(docs).collect())
    assert got == sorted(_expected(rows, tokenizer))


def test_empty_table(spark):
    assert wavelet.query(spark.createDataFrame([], SCHEMA)).count() == 0

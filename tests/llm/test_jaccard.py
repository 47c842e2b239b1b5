"""Links by shared five-word shingles against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stocktide.llm import jaccard, simhash


def _set(text):
    words = (text or "").encode().lower().split()
    reach = min(5, len(words))
    return frozenset(b" ".join(words[i : i + reach]) for i in range(len(words) - reach + 1)) if words else frozenset()


def _alike(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b)


def _expected(rows):
    sets = {}
    for doc, text in rows:
        sets.setdefault(_set(text), []).append(doc)
    label = {s: s for s in sets}

    def top(s):
        while label[s] is not s:
            s = label[s]
        return s

    order = list(sets)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if _alike(a, b):
                label[top(a)] = top(b)
    groups = {}
    for s, docs in sets.items():
        groups.setdefault(top(s), []).extend(docs)
    return sorted(sorted(g) for g in groups.values())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    made = ["", " \n", "one two", "One  two", "a b c d e", "a b c d e f"]
    for size in (30, 60, 120, 200):
        for _ in range(8):
            base = [rng.choice(words) for _ in range(size)]
            for edits in (0, 1, 1, 2, 3, 4, 5):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(size)] = rng.choice(words)
                made.append(" ".join(copy))
    hot = [rng.choice(words) for _ in range(150)]
    for _ in range(120):  # a large group of near copies, some too far from all others
        copy = list(hot)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(150)] = rng.choice(words)
        made.append(" ".join(copy))
    return list(enumerate(made))


@pytest.mark.parametrize("block", [7, jaccard.BLOCK])
def test_groups_equal_brute_force(spark, texts, block):
    docs = spark.createDataFrame([*texts, (None, None)], "doc_id bigint, text string")
    groups = {}
    for r in jaccard.near_groups(docs, block).collect():
        groups.setdefault(r["component"], []).append(-1 if r["doc_id"] is None else r["doc_id"])
    assert sorted(sorted(g) for g in groups.values()) == _expected([*texts, (-1, "")])


def test_stage_keeps_one_of_each_similar_group(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = corpus_pipeline.keep_one_of_near(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(g[0] for g in _expected(texts))


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_stage_on_the_tables(spark, sf_dir, table):
    sf_dir = f"{sf_dir}/../{table}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = corpus_pipeline.keep_one_of_near(spark, docs, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(g[0] for g in _expected(rows))


def test_repeated_long_and_clashing_rows(spark):
    rng = random.Random(6)
    long = " ".join(rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(60_000))
    rows = [(1, long), (2, long + " one more word"), (3, "short"), (4, None), (5, "SHORT"), (None, "short")] + [(6, "a row many times over")] * 90
    columns = "node string, grp string, cell string, mark string, items string, value string, fragment string"
    docs = spark.createDataFrame([(*r, *["clash"] * 7) for r in rows], f"doc_id bigint, text string, {columns}").repartition(4)
    kept = [(r["doc_id"], (r["text"] or "")[:5]) for r in jaccard.kept_rows(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(1, long[:5]), (3, "short"), (4, ""), (6, "a row")], key=repr)


def test_a_cell_returns_a_forest_not_its_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 40, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: 300 - i % 3], rng.integers(0, 1 << 40, i % 3).astype(np.uint64)])) for i in range(500)]
    sets += [np.unique(rng.integers(0, 1 << 40, 300).astype(np.uint64)) for _ in range(40)]
    asked = []

    class Counted(jaccard.Sets):
        def like(self, at, others):
            asked.append(at)
            return super().like(at, others)

    found = list(jaccard.forest(np.arange(540), Counted([s.tobytes() for s in sets]).like))
    assert len(found) == 499 and len(asked) < 60  # one for the near copies, one for each row that is like no other


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard.kept_rows(docs).count() == 0


def _apart(a, b):
    return (simhash.fingerprint(a.encode()) ^ simhash.fingerprint(b.encode())).bit_count()


def _groups(found):
    groups = {}
    for r in found.collect():
        groups.setdefault(r["component"], []).append(r["doc_id"])
    return sorted(sorted(g) for g in groups.values())


def test_golay_keys_find_near_texts_without_a_band(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    made = []
    while len(made) < 60:
        base = [rng.choice(words) for _ in range(300)]
        copy = list(base)
        copy[rng.randrange(300)] = "other"
        if _apart(" ".join(base), " ".join(copy)) <= simhash.MOST_BITS:
            made += [" ".join(base), " ".join(copy), " ".join(copy).upper()]
    nodes = jaccard.nodes
    monkeypatch.setattr(jaccard, "nodes", lambda docs: nodes(docs).withColumn("bands", F.array().cast("array<bigint>")))
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    assert _groups(jaccard.near_groups(docs)) == _expected(list(enumerate(made))) == [[i, i + 1, i + 2] for i in range(0, 60, 3)]


@pytest.mark.parametrize("block", [7, jaccard.BLOCK])
def test_near_fingerprints_are_joined_only_where_sets_are_alike(spark, block):
    rng = random.Random(9)
    passage = " ".join(f"w{i}" for i in range(21)) + " "  # many times over, it decides the fingerprint and not the set
    made = [passage * 60 + " ".join(f"v{rng.randrange(5000)}" for _ in range(30)) for _ in range(30)]
    made += [m + " w0" for m in made[:10]]
    assert all(_apart(made[0], m) <= simhash.MOST_BITS for m in made)
    rows = list(enumerate(made))
    expected = _expected(rows)
    assert len(expected) == 30
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _groups(jaccard.near_groups(docs, block)) == expected

"""The manifest's trees, proofs and checks against trees of plain lists."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from stocktide.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp string, pos string, node string, uid string, _part string"


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _hash(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_hash(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def _expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[source] = _tree([_leaf(r) for r in by_source[source]])
    top, made = _tree([trees[s][-1][0] for s in order]), []
    for number, source in enumerate(order):
        for place, row in enumerate(by_source[source]):
            steps = []
            for levels, at in ((trees[source], place), (top, number)):
                for level in levels[:-1]:
                    left = at - at % 3
                    steps.append((level[left : left + 3], at - left))
                    at //= 3
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = _leaf((*row[:4], text))
            for run, at in steps:
                node = _hash(*(node if i == at else other for i, other in enumerate(run)))
            proof = _hash(*(other for run, at in steps for i, other in enumerate(run) if i != at))
            made.append((row[0], _leaf(row), trees[source][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return made


def _frame(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], SCHEMA).repartition(5)


def _bag(rows):
    return sorted(map(repr, rows))


@pytest.fixture(scope="module")
def rows():
    made = [(i, "hot", "en", i % 3, f"line {i}\nline\n") for i in range(300)]
    made += [(i, f"s{i % 11}", None, None, ["", None, "\n", "é\n"][i % 4]) for i in range(300, 360)]
    made += [(i, None, "de", 5, "no source\n") for i in range(360, 371)] + [(-5, "é", "fr", 1, "one"), (None, "hot", None, 2, "no id\n")]
    return made + [(400, "Z", "en", 1, "x" * 200_000 + "\n"), (12, "hot", "xx", 9, "same id\n")] + [(401, "hot", "en", 3, "a row\nmany times")] * 150


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_equals_plain_trees(spark, rows, levels):
    assert _bag(tuple(r) for r in merkle.query(_frame(spark, rows), levels).collect()) == _bag(_expected(rows))


@pytest.mark.parametrize("n", [1, 3, 4, 10])
def test_small_tables(spark, n):
    rows = [(i, "one", None, None, "t\n") for i in range(n)]
    assert _bag(tuple(r) for r in merkle.query(_frame(spark, rows)).collect()) == _bag(_expected(rows))
    apart = [(i, f"s{i}", None, None, "t\n") for i in range(n)]
    assert _bag(tuple(r) for r in merkle.query(_frame(spark, apart)).collect()) == _bag(_expected(apart))


def test_only_some_levels_are_stored(spark, rows):
    made = merkle.manifest(merkle.hashed_rows(_frame(spark, rows)), 2)
    assert [level.count() for level in made.levels] == [len(rows), 66, 20, 15]  # a ninth each, every source rounded up
    assert made.root() == _expected(rows)[0][3]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.query(empty).count() == 0 and merkle.manifest(merkle.hashed_rows(empty)).root() is None

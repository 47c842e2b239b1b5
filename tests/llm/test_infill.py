"""Fill-in-the-middle texts against slices of plain strings."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktide.llm import infill

SCHEMA = "doc_id bigint, text string, n string, form string, output string, h1 string, h2 string"


def _texts():
    rng = random.Random(2)
    letters = ["a", "b", " ", "\n", "é", "日", "\U0001f600", "́", "<", "P", ">", "S", "M", "\t"]
    made = [None, "", "x", "<P>", "a<S>b", "<M", "<<S", "  ", " lead and trail \n", "日" * 5000]
    made += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 3000))) for _ in range(150)]
    return made + ["many units " * 40_000]


@pytest.fixture(scope="module")
def rows():
    found = list(enumerate(_texts()))
    return [*found, found[20], found[20], (None, "no id at all")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def _units(text, unit):
    if unit == "code_point":
        return list(text)
    found = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return [text[s:e] for s, e in zip([0, *found[1:]], [*found[1:], len(text)])] if found else []


def _expected(doc, text, unit):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = _units(text, unit)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if n:
        prefix, middle = "".join(units[:a]), "".join(units[a:b])
    else:
        prefix, middle = "", ""
    suffix = text[len(prefix) + len(middle) :]
    if h[3] % 100 < 20:
        return doc, n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return doc, n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


@pytest.mark.parametrize("block", [1, 7, infill.BLOCK])
@pytest.mark.parametrize("unit", infill.UNITS)
def test_cuts_and_restored_texts(docs, rows, unit, block):
    got = infill.transformed(docs, unit, block=block).withColumn("back", infill.restored()).collect()
    plain = lambda r: tuple((v is not None, v) for v in r)
    key = lambda r: repr(r)
    assert sorted(map(plain, (tuple(r)[:6] for r in got)), key=key) == sorted((plain(_expected(*r, unit)) for r in rows), key=key)
    assert sorted(r["back"] for r in got) == sorted(text or "" for _, text in rows)


def test_query_digests(docs, rows):
    got = {r["doc_id"]: r for r in infill.query(docs).collect()}
    for doc, text in rows:
        want = _expected(doc, text, "code_point")
        assert got[doc]["output_sha256"] == hashlib.sha256(want[3].encode()).hexdigest()
        assert got[doc]["restored_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_descent_finds_the_block():
    rng = np.random.default_rng(3)
    for blocks in (1, 2, 3, 8, 13):
        counts = rng.integers(0, 4, (blocks, 2))
        counts[0, 0] += 1
        tree, ends = infill.BlockTree(counts), np.cumsum(counts, axis=0)
        for unit in range(int(ends[-1, 0])):
            block = int(np.searchsorted(ends[:, 0], unit, "right"))
            before = ends[block - 1].tolist() if block else [0, 0]
            assert tree.descend(unit) == (block, *before)


def test_empty_table(spark):
    made = infill.query(spark.createDataFrame([], SCHEMA))
    assert made.count() == 0 and dict(made.dtypes)["prefix_chars"] == "bigint"


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        infill.transformed(spark.createDataFrame([], SCHEMA).withColumn("more", F.lit(1)), "sentence")

"""The stages on the smallest tables, each against what brute force says about its own input."""

from __future__ import annotations

from collections import Counter

from test_jaccard import _expected
from test_operators import WORD, _lower, _targets

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number == 4:
            break
        assert docs.columns == COLUMNS
        after = [tuple(r) for r in docs.collect()]
        assert set(after) <= set(before)
        if name == "quality":
            assert 0.7 < len(after) / len(before) < 1
        elif name == "exact dedup":
            keep = {}
            for r in before:
                keep[_lower(r[1])] = max(r[0], keep.get(_lower(r[1]), r[0]))
            assert sorted(r[0] for r in after) == sorted(keep.values())
        elif name == "near dedup":
            groups = _expected([(r[0], r[1]) for r in before])
            assert sorted(r[0] for r in after) == sorted(g[0] for g in groups)
        else:
            sizes, taken = Counter(), Counter()
            for r in before:
                sizes[r[3]] += len(WORD.findall(r[1]))
            for r in after:
                taken[r[3]] += len(WORD.findall(r[1]))
            smallest = {s: min(len(WORD.findall(r[1])) for r in before if r[3] == s) for s in sizes}
            want = _targets(sizes)
            assert all(abs(taken[s] - want[s]) <= 0.15 * want[s] + smallest[s] for s in want)
            assert max(Counter(after).values()) <= 3
        before = after
    packed = [tuple(r) for r in docs.collect()]
    assert Counter(r[0] for r in packed if r[1] == 0) == Counter(r[0] for r in before)

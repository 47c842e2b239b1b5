"""Every text operator against brute force, on rows with nulls, ties, repeats, long texts and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stocktide.llm import exact, licenses, mixing, packing, pii, quality, shards, simhash, substrings, topk
from stocktide.llm.queries import oracle_sql, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, text_key string, size string,"
    " grp string, shard string, hub string, copies string, first string, _key string, path string"
)


def _rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, shared = prose(70), prose(300)
    near = shared.split()
    texts = [None, "", " \t\n", "one", "ONE", "one", "é ÄB ab", "ÄB É", passage, f"{prose(40)} {passage}\n{prose(30)}", f"{passage} {passage}"]
    texts += [f"{prose(30 + i)} {passage.upper() if i % 3 == 0 else passage}" for i in range(12)]
    texts += [shared] * 5 + [" ".join(near[:i] + ["changed"] + near[i + 1 :]) for i in (3, 150, 299)]
    texts += [prose(rng.randint(1, 200)) for _ in range(40)] + [prose(5000), "x" * 5000, "<|endoftext|> it's 's d"]
    texts += [
        "write to a.b+c@mail.example.org. or call +1 (555) 010-9999, card 4539 1488 0343 6467 or 4539148803436467!",
        "10.0.0.255 and 10.0.0.256 1.2.3.4.5 a@b @c.d x@y.z@w.v 555-0109999\nReleased under the MIT License.",
        "Licensed under the Apache License, Version 2.0.", "9" * 3000 + "@" * 3000, "+" * 500 + "1" * 500,
    ]
    extra = ["clash"] * 10
    rows = [(i, t, None if i % 7 == 0 else "en", [None, "a", "b", "b", "b"][i % 5], 1, *extra) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[3], (None, "one", None, None, None, *extra), (None, passage, None, None, None, *extra)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(items):
    return Counter(tuple(i) for i in items)


# ---- 9 exact ---------------------------------------------------------------------------


def _lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def _exact(rows):
    groups = {}
    for doc, text, _ in rows:
        groups.setdefault(_lower(text), []).append(doc)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(body.encode()).hexdigest()) for i in ids]
    return out, len(groups)


@pytest.mark.parametrize("batch_bytes", [1, exact.BATCH_BYTES])
def test_exact_equals_brute_force(docs, rows, batch_bytes):
    got = exact.deduplicate(docs, batch_bytes=batch_bytes).withColumn("sha", F.lower(F.hex("digest"))).collect()
    want, groups = _exact(rows)
    assert bag((r["doc_id"], r["keep_id"], r["group_size"], r["sha"]) for r in got) == bag(want)
    assert sum(r["kept"] for r in got) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_equal_digests_are_checked_by_bytes(docs, rows):
    got = exact.deduplicate(docs, digest=lambda t: bytes([t[0] % 4 if t else 0])).select("doc_id", "keep_id", "group_size").collect()
    assert bag(got) == bag((a, b, c) for a, b, c, _ in _exact(rows)[0])


# ---- 7 near ----------------------------------------------------------------------------


def _print(text):
    words = WORD.findall(_lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _components(prints):
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_near_equals_brute_force(docs, rows):
    got = simhash.query(docs).collect()
    prints = [(doc, _print(text)) for doc, text, _ in rows]
    label = _components({p for _, p in prints})
    least = {}
    for doc, p in prints:
        if doc is not None:
            least[label[p]] = min(doc, least.get(label[p], doc))
    assert bag(got) == bag((doc, f"{p:016x}", least.get(label[p])) for doc, p in prints)


@pytest.mark.parametrize("block", [5, 2048])
def test_links_lose_nothing(spark, block):
    rng = random.Random(3)
    prints = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([2, 4, 40])):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), block)
    got = {r["node"]: r["component"] for r in simhash.components(found).collect()}
    label = _components({p & (1 << 64) - 1 for p in signed})
    groups = {}
    for p in signed:
        groups.setdefault(label[p & (1 << 64) - 1], []).append(p)
    assert {p: got.get(p, p) for p in signed} == {p: min(g) for g in groups.values() for p in g}


def test_golay_corrects_three_errors():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 1 << 12, 300)
    words = (data << 11) | simhash._remainder(data << 11)
    for errors in range(4):
        flips = np.array([sum(1 << int(b) for b in rng.choice(23, errors, replace=False)) for _ in data])
        assert (simhash.nearest(words ^ flips) == data).all()


# ---- 5 substrings ----------------------------------------------------------------------


def _clean(rows):
    first = {}
    split = [(doc, WORD.findall(text)) for doc, text, _ in rows]
    for doc, words in split:
        for k in range(len(words) - 49):
            key = tuple(words[k : k + 50])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    for doc, words in split:
        covered = [False] * len(words)
        for k in range(len(words) - 49):
            if doc is not None and first[tuple(words[k : k + 50])] < doc:
                covered[k : k + 50] = [True] * 50
        yield doc, len(words), sum(covered), " ".join(w for w, c in zip(words, covered) if not c)


def test_substrings_equal_brute_force(docs, rows, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 120)
    monkeypatch.setattr(substrings, "TASK_WORDS", 200)
    assert bag(substrings.clean(docs).collect()) == bag(_clean(rows))


def test_automaton_knows_all_substrings():
    rng = random.Random(2)
    for _ in range(50):
        refs = [[rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(4)]
        automaton = substrings.Automaton()
        for doc, words in enumerate(refs):
            automaton.add(words, doc)
        automaton.finish()
        asked = [rng.choice("abcd") for _ in range(15)]
        has = lambda d, w: any(refs[d][i : i + 3] == w for i in range(len(refs[d]) - 2))
        want = [k for k in range(13) if any(has(d, asked[k : k + 3]) for d in range(2))]
        assert list(automaton.matches(asked, 2, 3)) == want


# ---- 1 personal data --------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _checked(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def _base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if _checked(k, m.group())]


def test_base_spans_equal_the_patterns(docs, rows):
    got = pii.query(docs).collect()
    assert bag((r["doc_id"], r["base_sha256"]) for r in got) == bag(
        (doc, hashlib.sha256(",".join(_base(text)).encode()).hexdigest()) for doc, text, _ in rows if len(text) < 1 << 20
    )
    assert all(set(_base(t)) <= set(r["spans"].split(",")) for r in got for d, t, _ in rows if d == r["doc_id"] and d is not None)


def test_patterns_on_random_text():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789.-+@ ()a%") for _ in range(rng.randint(0, 40)))
        assert pii.listed(pii.base_spans(text)) == ",".join(_base(text))


def test_repeated_entities_carry_one_label():
    texts = [f"word {i} call +1 (555) 010-{1000 + i} or a{i}@mail.example.com end {i * 17} of it" for i in range(60)]
    model = pii.fit(pii.graph_of(texts, [pii.base_spans(t) for t in texts]))
    text = "call +1 (555) 010-9876 today, later +1*** (555)%%% 010-9876### again; room 12"
    base = [pii.base_spans(text)]
    added = pii.added_spans([text], base, model)[0]
    assert [text[s:e] for s, e in added[3]] == ["+1*** (555)%%% 010-9876"]
    clean = "no data in 2024, chapter 12, version 3.1.4 and 77 trees"
    assert pii.added_spans([clean], [pii.base_spans(clean)], model) == [[[], [], [], []]]


# ---- 2 shards ---------------------------------------------------------------------------


def test_shards_are_even_and_keep_groups(docs, rows):
    got = shards.query(docs).collect()
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == bag(
        (doc, len(text.encode()) + 1, zlib.crc32(text.encode())) for doc, text, _ in rows
    )
    counts = Counter(r["shard"] for r in got)
    assert set(counts) <= set(range(16)) and max(counts.values()) - min(counts.get(i, 0) for i in range(16)) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in counts.items())


def test_labels_gather_linked_rows(spark):
    rows = [(i, f"text {i // 4}", "en", "a", 1) for i in range(4000)] + [(9000 + i, "hot", "en", "a", 1) for i in range(2000)]
    found = shards.assign(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    per = found.groupBy("hub", "shard").count().groupBy("hub").agg(F.max("count").alias("m"), F.sum("count").alias("n"))
    kept = per.filter("n = 4").agg(F.sum("m") / F.sum("n")).first()[0]
    assert kept > 0.8  # 0.33 where shards are drawn at random
    sizes = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 1


def _cut(edges, place):
    return sum(place[a] != place[b] for a, b in edges)


def test_rounds_cut_fewer_edges_and_keep_to_the_share(spark):
    """Groups of equal rows over four shards, against the places they start from."""
    rng = random.Random(12)
    rows = [(f"hub{h}", i) for h, n in enumerate([2, 2, 3, 5, 8, 13, 20]) for i in range(n)]
    start = {row: rng.randrange(4) for row in rows}
    counts = Counter((h, p, start[h, p]) for h, p in rows)
    cells = spark.createDataFrame([(h, p, s, n) for (h, p, s), n in counts.items()], "hub string, piece int, shard int, n bigint")
    edges = [(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[0] == b[0]]
    for fixed in ([20] * 4, [0] * 4, [0, 0, 0, 60]):
        share = (len(rows) + sum(fixed)) // 4
        before, sizes = _cut(edges, start), Counter(start.values())
        for rounds in (1, 2, 4):
            end = {(r["hub"], r["piece"]): r["shard"] for r in shards.propagate(cells, fixed, rounds).collect()}
            assert sorted(end) == sorted(start) and _cut(edges, end) <= before
            before = _cut(edges, end)
            assert all(n <= max(share, sizes[s]) for s, n in Counter(end.values()).items())
        # without other rows the largest group can't stay whole
        assert before < _cut(edges, start) / (2 if sum(fixed) else 1)


def test_groups_stay_whole_where_there_is_room(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    places, hubs = {}, Counter()
    for r in shards.assign(docs).filter("linked").collect():
        places.setdefault(r["hub"], set()).add(r["shard"])
        hubs[r["hub"]] += 1
    small = [h for h, n in hubs.items() if n <= docs.count() // 64]
    assert small and all(len(places[h]) == 1 for h in small)


# ---- 3 top k ----------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = random.Random(4)
    vectors = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(400)]
    vectors += [(400 + i, vectors[0][1]) for i in range(40)] + [(500, None), (501, [0.1, None]), (502, [float("nan")]), (520, [float("inf")]), (540, [])]
    vectors += [(None, [1.0]), (560, [0.5, 0.5])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id bigint, embedding array<float>, label int, score string")
    whole = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [int(np.floor(64.0 * float(np.float32(x)))) for x in v]
    want = []
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:20]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores, start=1)]
    assert bag(topk.query(table).collect()) == bag(want)
    assert topk.query(table.limit(0)).count() == 0


# ---- 4 quality --------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, sf_dir):
    table, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.query(table, labels).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    apart = [r for r in got if r["held_out"]]
    good, bad = ([r["predicted"] for r in apart if r["quality"] == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.9 and sum(bad) / len(bad) < 0.2


def test_quality_edge_rows(docs, empty, rows, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (5, 1, 0), (5, 0, 1), (None, 1, None), (9, None, None)], none.schema)
    for labels in (none, one):
        got = quality.query(docs, labels).collect()
        assert bag((r["doc_id"],) for r in got) == bag((doc,) for doc, _, _ in rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert quality.accepted_rows(docs, none).columns == ["doc_id", "text", "lang", "source", "n_chars"]


# ---- 6 mixing ---------------------------------------------------------------------------


def _targets(sizes):
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left = {}, float(sum(sizes.values()))
    while True:
        rest = [s for s in order if s not in target]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]


def test_mix_meets_targets(docs, rows):
    got = mixing.query(docs).collect()
    assert bag((r["doc_id"], r["size"]) for r in got) == bag((doc, len(WORD.findall(text))) for doc, text, _ in rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text))
    source_of = {(doc, len(WORD.findall(text))): s for doc, text, s in rows}
    want, taken = _targets(sizes), Counter()
    for r in got:
        s = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[s] += r["taken"]
    assert {s: (taken[s], want[s]) for s in want if abs(taken[s] - want[s]) > 0.03 * want[s] + 5} == {}
    assert bag(got) == bag(mixing.query(docs.repartition(5)).collect())


def test_flow_shares_overlapping_sources():
    patterns = [(("a",), 100), (("a", "b"), 100), (("b",), 10)]
    flow = mixing.route(patterns, {"a": 150, "b": 160})
    assert sum(flow[p, "a"] for p in range(2)) == 150 and sum(flow[p, "b"] for p in (1, 2)) == 160
    used = [sum(f for (p, _), f in flow.items() if p == i) for i in range(3)]
    # each token once (210), the other 100 as second copies: no third copy is needed
    assert sum(used) == 310 and all(u <= 2 * s for u, (_, s) in zip(used, patterns))


# ---- 8 packing --------------------------------------------------------------------------


def test_packing_round_trip(docs, rows, monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    monkeypatch.setattr(packing, "BLOCK", 16)
    got = packing.packed(docs, block=16).collect()
    tokenizer = tokenizers.Tokenizer.from_file(packing.vocabulary_path())
    want = []
    for doc, text, _ in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want.append((doc, n, at, len(part), zlib.crc32(part.tobytes())))
    assert bag(r[:5] for r in got) == bag(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(w[3] for w in want) // 2048) + 1


def test_crossover_keeps_all_pieces():
    rng = random.Random(8)
    sizes = [rng.randint(1, 99) for _ in range(200)]
    people = packing.evolve(sizes, 100, [], rng)
    child = packing.cross(people[0], packing.best_fit(sizes, 100, 0.5, rng), sizes, 100, rng)
    assert sorted(i for g in child for i in g) == list(range(200))
    assert all(sum(sizes[i] for i in g) <= 100 for g in child)


def test_samples_hold_one_row_for_each_id(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd"), (2, "text")] + [(3, "call +1 555 0100 200")] * 300, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id bigint, quality int")
    assert len(quality._sample(docs, labels)) <= 3
    pii.train(docs)


def test_digits_far_into_a_long_token():
    core = "." * 5000 + "5550100"
    graph = pii.graph_of([f"x{core} 5550100"], [[[] for _ in range(4)]])
    assert graph.skip.tolist() == [[0, 1]]  # the last seven digits are the same
    assert pii.features("x" * 5000 + "1")[14]


# ---- 10 licences ------------------------------------------------------------------------


def test_licenses_and_inheritance(spark):
    prose = "some words that are not about it\nand more of them"
    files = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x/code.py", prose), ("a/x/y/z.py", prose), ("a/x/y/LICENSE.txt", "Licensed under CC BY-NC 4.0."),
        ("b/own.py", f"{prose}\n# Licensed under the Apache License, Version 2.0.\n{prose}"), ("b/c/none.py", prose), ("top.py", ""), (None, prose), ("a/x/empty", None),
    ] + [(f"c/{i}.py", prose) for i in range(60)]
    table = spark.createDataFrame([(*f, "clash") for f in files], "path string, text string, uid string")
    found = licenses.inherit(licenses.scan(table.withColumn("text", F.coalesce("text", F.lit(""))).drop("uid")))
    got = {r["path"]: (r["license"], r["inherited"], r["inherited_from"]) for r in found.collect()}
    assert got["a/LICENSE"][0] == "MIT" and got["b/own.py"] == ("Apache-2.0", None, None)
    assert got["a/x/code.py"] == (None, "MIT", "a") and got["a/x/y/z.py"] == (None, "CC-BY-NC-4.0", "a/x/y")
    assert got["b/c/none.py"] == (None, None, None) and got["a/x/empty"] == (None, "MIT", "a")
    assert len(found.collect()) == len(files)


# ---- all --------------------------------------------------------------------------------


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    made = [
        pii.query(empty), shards.query(empty), quality.query(empty, labels), substrings.query(empty), mixing.query(empty),
        simhash.query(empty), packing.query(empty), exact.query(empty), licenses.query(empty), exact.kept_rows(empty),
        simhash.kept_rows(empty), mixing.mixed_rows(empty), quality.accepted_rows(empty, labels),
    ]
    assert [df.count() for df in made] == [0] * len(made)


def test_licenses_edge_rows(docs, rows):
    assert bag((r["doc_id"],) for r in licenses.query(docs).collect()) == bag((doc,) for doc, _, _ in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_equal_sql(spark, duck, sf_dir, name):
    from compare import differences

    assert differences(queries()[name](spark, sf_dir), duck, oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))

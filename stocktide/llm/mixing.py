"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A
flow network over patterns and sources routes token capacity: a pattern offers its
tokens once at no cost, a second and a third time at rising cost, and every source
takes up to its target. Patterns and sources are all that reaches the driver. Then
seeded documents are selected: a pattern's documents lie on a line in hash order, the
flow takes whole passes over it and a prefix of the next one, and a few rounds fill the
rest of the last pass with documents that still fit, at last one at a time; no document
is taken more than ``MOST_COPIES`` times.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.text import DOCUMENT_COLUMNS, narrow, over_batches, rows_back, text_key, texts, words_of
from stocktide.session import staged

WEIGHTS = (1.0, 2.0, 3.0)  # repeating over the sources in code point order, null last
MOST_COPIES = 3
COPY_COSTS = (0, 1, 3)  # cost of a token's first, second and third copy
SEED = 17
BUCKETS = 4096
FILL_ROUNDS = 2
REPEAT_ROUNDS = 2
LAST_PICKS = 3


def ordered_sources(names: list[str | None]) -> list[str | None]:
    """By code point, null last."""
    return sorted((n for n in names if n is not None)) + [n for n in names if n is None]


def targets_of(sizes: dict, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> dict:
    """Target of each source: its weight's share of all sizes, never above ``most`` times its own
    size; what is above goes to the others by weight."""
    order = ordered_sources(list(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), list(order), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / whole for s in open_}
        full = [s for s in open_ if share[s] > most * sizes[s]]
        if not full:
            return {**target, **share}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ = [s for s in open_ if s not in full]
    return target


def route(patterns: list[tuple[tuple, int]], quotas: dict) -> dict[tuple[int, object], int]:
    """Min-cost flow from patterns (sources, tokens) to quotas: tokens per (pattern, source).

    Successive cheapest augmenting paths over the residual network, so every route is
    of least total repetition cost for the tokens it places.
    """
    used = [0] * len(patterns)
    flow: dict[tuple[int, object], int] = {(p, s): 0 for p, (names, _) in enumerate(patterns) for s in names}
    left = dict(quotas)

    def next_copy(p: int) -> tuple[int, int]:
        size = patterns[p][1]
        level = used[p] // size if size else MOST_COPIES
        return (COPY_COSTS[level], size * (level + 1) - used[p]) if level < MOST_COPIES else (-1, 0)

    members: dict[object, list[int]] = {}
    for p, (names, _) in enumerate(patterns):
        for s in names:
            members.setdefault(s, []).append(p)
    while True:
        # cheapest pattern that reaches an open source, perhaps by handing routes over
        best = None
        for p in range(len(patterns)):
            cost, room = next_copy(p)
            if not room or (best and cost >= best[0]):
                continue
            seen, queue = {("p", p): None}, deque([("p", p)])
            while queue:
                node = queue.popleft()
                if node[0] == "s" and left[node[1]] > 0:
                    best = (cost, room, node, seen)
                    break
                if node[0] == "p":
                    near = [("s", s) for s in patterns[node[1]][0]]
                else:
                    near = [("p", q) for q in members[node[1]] if flow[q, node[1]] > 0]
                for other in near:
                    if other not in seen:
                        seen[other] = node
                        queue.append(other)
            if best and best[0] == 0:
                break
        if best is None:
            return flow
        _, amount, node, seen = best
        path = [node]
        while seen[path[-1]] is not None:
            path.append(seen[path[-1]])
        path.reverse()  # p, s, p, s, ...
        amount = min(amount, left[node[1]])
        steps = list(zip(path, path[1:]))
        for a, b in steps:
            if a[0] == "s":
                amount = min(amount, flow[b[1], a[1]])
        for a, b in steps:
            if a[0] == "p":
                flow[a[1], b[1]] += amount
            else:
                flow[b[1], a[1]] -= amount
        used[path[0][1]] += amount
        left[node[1]] -= amount


def line(df: DataFrame, group: str, value: str, order: list[str]) -> DataFrame:
    """``_start``: sum of ``value`` over the rows before, in hash order within ``group``. ``order`` starts with
    the hash. Sums per hash bucket carry a group over many tasks."""
    bucket = F.pmod(F.shiftright(F.col(order[0]), 40), F.lit(BUCKETS)).cast("int")
    rows = df.withColumn("_bucket", bucket)
    sums = rows.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(group).alias("_group"), F.col("_bucket").alias("_own"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_own")))
    return placed.withColumn("_start", F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop(
        "_bucket", "_group", "_own", "_base"
    )


def mix(items: DataFrame, weights: tuple = WEIGHTS, seed: int = SEED) -> tuple[DataFrame, dict]:
    """``items`` (uid, doc_id, text_key, sources array<string>, size) with ``pattern``, ``copies`` and
    ``routed`` (the source of each copy); and the target of each source.

    ``items`` has to be a stored table. A document of size 0 is taken as often as its pattern's
    whole passes. Without any words all targets are 0 and nothing is taken.
    """
    spark = items.sparkSession
    totals = items.select(F.explode("sources").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("n"))
    sizes = {r["source"]: r["n"] for r in totals.collect()}
    targets = targets_of(sizes, weights)
    found = [(tuple(r["sources"]), r["n"]) for r in items.groupBy("sources").agg(F.sum("size").alias("n")).collect()]
    found.sort(key=lambda x: [(s is None, s or "") for s in x[0]])
    flow = route(found, {s: round(t) for s, t in targets.items()})
    plan = []
    for p, (names, size) in enumerate(found):
        bounds, at = [], 0
        for s in names:
            at += flow[p, s]
            bounds.append((at, s))
        passes, rest = divmod(at, size) if size else (0, 0)
        plan.append((p, list(names), size, passes, rest, bounds))
    schema = "pattern int, sources array<string>, whole bigint, passes bigint, rest bigint, bounds array<struct<upto:bigint,source:string>>"
    plans = spark.createDataFrame(plan, schema)
    rows = items.join(plans.select("pattern", "sources", "passes", "rest", "whole"), "sources").withColumn(
        "_hash", F.xxhash64(F.lit(seed), "doc_id", "text_key")
    )
    order = ["_hash", "uid"]
    rows = staged(line(rows, "pattern", "size", order), "mix-line")
    taken = rows.filter("rest > 0 and size > 0 and _start + size <= rest").select("uid", "pattern", "size")
    taken = staged(taken, "mix-taken")
    for number in range(FILL_ROUNDS + REPEAT_ROUNDS + LAST_PICKS):
        used = taken.groupBy("pattern").agg(F.sum("size").alias("used"))
        gaps = plans.select("pattern", "rest").join(used, "pattern", "left").select(
            "pattern", (F.col("rest") - F.coalesce("used", F.lit(0))).alias("gap")
        )
        again = taken.groupBy("uid").agg(F.count(F.lit(1)).alias("_again"))
        # documents not taken in this pass come first; where only too large ones are left, others are repeated
        most = 1 if number < FILL_ROUNDS else MOST_COPIES
        fitting = (
            rows.drop("_start").join(gaps, "pattern").filter("size > 0 and size <= gap").join(again, "uid", "left")
            .withColumn("_again", F.coalesce("_again", F.lit(0))).filter((F.col("_again") < most) & (F.col("passes") + F.col("_again") < MOST_COPIES))
        )
        if number < FILL_ROUNDS + REPEAT_ROUNDS:
            more = line(fitting, "pattern", "size", order).filter("_start + size <= gap").select("uid", "pattern", "size")
        else:  # the largest one that fits
            largest = fitting.groupBy("pattern").agg(F.max(F.struct("size", *order)).alias("largest"))
            more = largest.select("largest.uid", "pattern", "largest.size")
        taken = staged(taken.unionByName(more), "mix-taken")
    extra = taken.groupBy("uid").agg(F.count(F.lit(1)).alias("_extra"))
    chosen = rows.join(extra, "uid", "left")
    copies = (F.col("passes") + F.coalesce("_extra", F.lit(0))).cast("bigint")
    chosen = chosen.withColumn("copies", copies).join(plans.select("pattern", "bounds"), "pattern")

    def source_of(k: Column) -> Column:
        at = k * F.col("whole") + F.col("_start")
        fits = F.filter("bounds", lambda b: at < b["upto"])
        return F.coalesce(F.get(fits, F.lit(0)), F.element_at("bounds", -1))["source"]

    routed = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1), source_of))
    return chosen.select("uid", "doc_id", "text_key", "sources", "size", "copies", routed.alias("routed")), targets


def sized(docs: DataFrame) -> DataFrame:
    """Stored rows (uid, doc_id, text_key, sources, size): size in words, sources the row's own one."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = pa.array([len(words_of(t)) for t in texts(batch.column("text"))], pa.int64())
        names = ["uid", "doc_id", "text_key", "source"]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), counts], names=[*names, "size"])

    rows = narrow(docs, F.col("source").cast("string").alias("source")).withColumns(
        {"uid": F.monotonically_increasing_id(), "text_key": text_key()}
    )
    made = over_batches(rows, work, "uid bigint, doc_id bigint, text_key bigint, source string, size bigint")
    return staged(made.withColumn("sources", F.array("source")).drop("source"), "mix-items")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows the mix takes, each as often as it is taken, with the columns of documents."""
    chosen, _ = mix(sized(docs))
    copies = chosen.groupBy("doc_id", "text_key").agg(F.sum("copies").alias("_copies")).filter("_copies > 0")
    keep = [c for c in DOCUMENT_COLUMNS if c in docs.columns]
    once = rows_back(docs, copies, keep, "_copies")
    return once.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).select(*keep)


def query(docs: DataFrame) -> DataFrame:
    items = sized(docs)
    chosen, targets = mix(items)
    sizes = items.groupBy(F.col("sources")[0].alias("_source")).agg(F.sum("size").alias("source_size"))
    wanted = docs.sparkSession.createDataFrame(list(targets.items()), "_name string, target double")
    by_source = sizes.join(wanted, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    return chosen.join(by_source, F.col("sources")[0].eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )

"""Shards by balanced label propagation.

Documents and what links them form a bipartite graph: a hub (here: an equal text) and its
members. Labels are shards. In each round a hub counts its members per shard and asks
those in other shards to come to the shard where it has most of them; requests are
granted within quotas: as many rows come as leave or as there is room. Members of a hub
are held in at most ``PIECES`` pieces that move together, so a group with a third of all
rows is a bounded number of rows, and can still be spread over shards.

Afterwards shards that are above their quota hand rows, unlinked ones first, to those
that are below, so that row counts differ by one at most.

Everything is DataFrame operations; the driver sees one number per shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.session import staged

SHARDS = 16
ROUNDS = 4
PIECES = 1024
BUCKETS = 1024  # moves between two shards are granted in this many steps
SLOT_ROWS = 50_000  # rows numbered together


def _per_shard(values: list[int], shard: str) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("bigint") for v in values)), F.col(shard) + 1)


def _sizes(rows: DataFrame, count: Column, shards: int) -> list[int]:
    """One number per shard."""
    found = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(count.alias("n")).collect()}
    return [found.get(i, 0) for i in range(shards)]


def propagate(cells: DataFrame, fixed: list[int], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (hub, piece, shard, n: rows of a hub that move together) with the shards after some
    rounds. ``fixed`` counts the rows without links in each shard. ``cells`` has to be stored.

    A shard takes linked rows up to an even share of all rows: the rows without links that are then too many
    are handed over at the end, which cuts nothing."""
    shards = len(fixed)
    for number in range(rounds):
        sizes = _sizes(cells, F.sum("n"), shards)
        ceiling = (sum(fixed) + sum(sizes)) // shards
        there = cells.groupBy("hub", "shard").agg(F.sum("n").alias("n"))
        # ties differ from hub to hub, so that small hubs do not all ask for the same shard
        wishes = there.groupBy("hub").agg(F.max_by("shard", F.struct("n", F.xxhash64("hub", "shard"))).alias("wish"))
        bucket = F.pmod(F.xxhash64(F.lit(number), "hub", "piece"), F.lit(BUCKETS)).cast("int")
        asked = staged(cells.join(wishes, "hub").withColumn("bucket", bucket), "requests")
        steps = asked.filter("shard <> wish").groupBy("shard", "wish", "bucket").agg(F.sum("n").alias("n"))
        pairs = steps.groupBy("shard", "wish").agg(F.sum("n").alias("n"))
        back = pairs.select(F.col("wish").alias("shard"), F.col("shard").alias("wish"), F.col("n").alias("back"))
        into = pairs.groupBy("wish").agg(F.sum("n").alias("into"))
        room = _per_shard([max(0, ceiling - size) for size in sizes], "wish")
        # a swap leaves both sizes as they are; free room is shared out by what is asked
        quota = F.least(F.col("n"), F.coalesce("back", F.lit(0))) + F.floor(room * F.col("n") / F.col("into"))
        grants = pairs.join(back, ["shard", "wish"], "left").join(into, "wish").select("shard", "wish", quota.alias("quota"))
        upto = F.sum("n").over(Window.partitionBy("shard", "wish").orderBy("bucket"))  # at most BUCKETS rows
        granted = (
            steps.withColumn("upto", upto).join(grants, ["shard", "wish"]).filter("upto <= quota")
            .select("shard", "wish", "bucket", F.lit(True).alias("granted"))
        )
        moved = asked.join(granted, ["shard", "wish", "bucket"], "left")
        cells = staged(
            moved.select("hub", "piece", F.when(F.col("granted"), F.col("wish")).otherwise(F.col("shard")).alias("shard"), "n"),
            "labels",
        )
    return cells


def _even(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (uid, mark, linked, shard) with final ``shard`` and gapless ``slot``; counts differ by one at most."""
    sizes = _sizes(rows, F.count(F.lit(1)), shards)
    total = sum(sizes)
    quotas = [total // shards + (i < total % shards) for i in range(shards)]
    groups = max(1, -(-total // (shards * SLOT_ROWS)))
    # linked rows come first in a shard, so that what is handed over are unlinked ones where there are any
    group = F.pmod(F.xxhash64("mark", "uid"), F.lit(groups)) + F.when(F.col("linked"), 0).otherwise(groups)
    rows = rows.withColumn("group", group)
    counts = rows.groupBy("shard", "group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "group").orderBy("mark", "uid")) - 1
    placed = rows.withColumn("inside", inside).join(starts, ["shard", "group"]).withColumn("slot", F.col("start") + F.col("inside"))
    above, below, seen_above, seen_below, takes = [], [], 0, 0, []
    for size, quota in zip(sizes, quotas):
        above.append(seen_above - min(size, quota))
        below.append((seen_below, min(size, quota)))
        seen_above += max(0, size - quota)
        seen_below += max(0, quota - size)
        takes.append(seen_below)
    over = F.col("slot") >= _per_shard(quotas, "shard")
    turn = F.col("slot") + _per_shard(above, "shard")  # number among all rows that are handed over
    new = F.lit(shards - 1)
    for i in reversed(range(shards)):
        new = F.when(turn < takes[i], F.lit(i)).otherwise(new)
    placed = placed.withColumns({"_turn": turn, "_over": over}).withColumn("_new", F.when(over, new))
    slot = F.col("_turn") - _per_shard([b[0] for b in below], "_new") + _per_shard([b[1] for b in below], "_new")
    return placed.select(
        "uid", F.coalesce("_new", "shard").cast("int").alias("shard"), F.when(F.col("_over"), slot).otherwise(F.col("slot")).alias("slot")
    )


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, hub, linked, shard, slot for every row of ``docs``.

    Rows with equal texts are linked (a null text is empty). Row counts of shards differ by
    one at most; slots count from 0 without gaps. Repeated rows are rows of their own.
    """
    text = F.coalesce("text", F.lit(""))
    # xxhash64 names a hub: two texts that share it would only be one link too many
    rows = staged(
        docs.select(
            F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("hub"),
        ).withColumn("mark", F.xxhash64("doc_id", "hub")),
        "shard-rows",
    )
    hubs = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    piece = F.pmod(F.xxhash64("mark", "uid"), F.lit(PIECES)).cast("int")
    rows = staged(
        rows.join(hubs, "hub", "left").withColumns({"linked": F.col("members").isNotNull(), "piece": piece})
        .withColumn("shard", F.pmod("piece", F.lit(shards)).cast("int")).drop("members"),
        "shard-links",
    )
    cells = rows.filter("linked").groupBy("hub", "piece", "shard").agg(F.count(F.lit(1)).alias("n"))
    fixed = _sizes(rows.filter("not linked"), F.count(F.lit(1)), shards)
    cells = propagate(staged(cells, "labels"), fixed, rounds)
    labels = cells.select("hub", "piece", F.col("shard").alias("_label"))
    labelled = rows.join(labels, ["hub", "piece"], "left").withColumn("shard", F.coalesce("_label", "shard"))
    labelled = staged(labelled.select("uid", "mark", "linked", "shard"), "shard-labels")
    placed = _even(labelled, shards)
    return rows.drop("shard").join(placed, "uid").select("doc_id", "size", "text_crc32", "hub", "linked", "shard", "slot")


def query(docs: DataFrame) -> DataFrame:
    """The law is ``rows``: counts at most one apart."""
    return assign(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

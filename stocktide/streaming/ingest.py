"""Streams into tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stocktide import contracts as C
from stocktide.operators import validate as V


def _start(writer, once: bool, every: str) -> StreamingQuery:
    """Commit on a fixed cadence, or drain what is there and stop."""
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def append_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
    once: bool = False, every: str = C.COMMIT_INTERVAL,
) -> StreamingQuery:
    """Append rows to a Parquet table; the sink's own log makes every batch count once."""
    writer = df.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer.option("path", path).option("checkpointLocation", checkpoint), once, every)


def consume(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "append", once: bool = False, every: str = C.COMMIT_INTERVAL,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``. After a failure the last batch is delivered again
    under the same id, so handlers write below a folder named after it."""
    writer = df.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _start(writer, once, every)


def send_to_broker(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, once: bool = False, every: str = C.COMMIT_INTERVAL
) -> StreamingQuery:
    """Write a ``value`` column to a Kafka topic; needs the Kafka connector on the class path."""
    writer = messages.select("value").writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return _start(writer.option("topic", topic).option("checkpointLocation", checkpoint), once, every)


def batch_folder(path: str, batch: int) -> str:
    return f"{path}/_batch={batch}"


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Idempotent: a redelivered batch replaces its own folder."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(batch_folder(path, batch))


class Carried:
    """A small table that every batch hands to the next one.

    Two folders are written in turn, so a batch that is delivered again still finds what its
    predecessor left, and there are never more than two of them.
    """

    def __init__(self, path: str, schema: str):
        self.path, self.schema = path, schema

    def _folder(self, batch: int) -> str:
        return f"{self.path}/turn={batch % 2}"

    def before(self, spark: SparkSession, batch: int) -> DataFrame:
        if batch == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._folder(batch - 1))

    def after(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(batch))


def split_stream(
    tagged: DataFrame, valid_path: str, rejected_path: str, checkpoint: str, once: bool = False,
    every: str = C.COMMIT_INTERVAL,
) -> StreamingQuery:
    """Valid rows and dead letters from one pass over each micro-batch.

    The pass is written beside the checkpoint, replacing the one of the batch before: typed rows of valid messages, and
    messages only of the others. Held in executors, a batch would be both for all of them, uncompressed.
    """
    judged = f"{checkpoint}-judged"

    def handle(batch: DataFrame, number: int) -> None:
        passed = F.col("reason").isNull()
        slim = batch.withColumns({
            c: F.when(passed, F.col(c)) if c == "row" else F.when(~passed, F.col(c)) for c in batch.columns if c != "reason"
        })
        slim.write.mode("overwrite").option("compression", "zstd").parquet(judged)
        once_judged = batch.sparkSession.read.schema(batch.schema).parquet(judged)
        write_batch(V.valid(once_judged), valid_path, number)
        write_batch(V.rejected(once_judged), rejected_path, number)

    return consume(tagged, handle, checkpoint, once=once, every=every)


def ingest_retail(
    spark: SparkSession, sources: dict[str, DataFrame], root: str, compat: bool = False, once: bool = False,
) -> dict[str, StreamingQuery]:
    """Orders, inventory and customers side by side, each with its own checkpoint.

    ``sources`` holds the message stream of each kind; rows land in ``raw/<kind>``, rejected
    messages in ``rejected/<kind>``.
    """
    taggers = {"orders": V.tag_orders, "inventory": V.tag_inventory, "customers": V.tag_customers}
    return {
        kind: split_stream(
            taggers[kind](stream, compat=compat), f"{root}/raw/{kind}", f"{root}/rejected/{kind}",
            f"{root}/checkpoints/{kind}", once=once,
        )
        for kind, stream in sources.items()
    }


def drained(queries: dict[str, StreamingQuery] | StreamingQuery) -> None:
    """Wait for queries started with ``once``; errors of any of them are raised."""
    for query in queries.values() if isinstance(queries, dict) else [queries]:
        query.awaitTermination()


def land_by_day(df: DataFrame, path: str, checkpoint: str, day: Column | None = None, once: bool = False) -> StreamingQuery:
    """Late rows go to the day they happened on (by default the day of ``ts`` in the session's
    time zone), not to the day they arrived on."""
    day = F.to_date("ts") if day is None else day
    return append_stream(df.withColumn("date", day), path, checkpoint, ["date"], once=once)

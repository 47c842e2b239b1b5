"""Exact deduplication by a stateful stream.

Every row becomes a narrow arrival (digest, id, locator). A streaming aggregation keeps
one state row per digest in the disk-backed RocksDB store, without a watermark, so
nothing ever expires: the greatest id seen, where its text lies, and the number of
rows. Partial aggregation sends one row per digest and task, so a group with a third
of all rows is no hot key. Rows that hit a known digest are then compared by their
full bytes; texts that only share a digest become groups of their own.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.llm.text import narrow, over_batches, rows_back, text_key, texts
from stocktide.session import scratch_path

BATCH_BYTES = 16 << 30  # arrivals taken into one micro-batch
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # else every partition's store sets megabytes of empty log aside
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
ARRIVAL = "uid bigint, doc_id bigint, text_key bigint, digest binary, digest_size int"


def normalised(text: bytes) -> bytes:
    """``bytes.lower`` changes A-Z only."""
    return text.lower()


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def arrivals(docs: DataFrame, digest=sha256) -> tuple[DataFrame, str]:
    """One narrow row per row of ``docs``, written once so that row numbers stay fixed; and its path."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lowered = [normalised(t) for t in texts(batch.column("text"))]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("uid"), batch.column("doc_id"), batch.column("text_key"),
                pa.array(map(digest, lowered), pa.binary()), pa.array(map(len, lowered), pa.int32()),
            ],
            names=["uid", "doc_id", "text_key", "digest", "digest_size"],
        )

    rows = narrow(docs).withColumns({"uid": F.monotonically_increasing_id(), "text_key": text_key()})
    path = scratch_path(docs.sparkSession, "arrivals")
    over_batches(rows, work, ARRIVAL).write.parquet(path)
    return docs.sparkSession.read.schema(ARRIVAL).parquet(path), path


def stream_state(spark: SparkSession, path: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The state after all arrivals below ``path``: digest, keeper (doc_id, uid, text_key), n.

    Each micro-batch writes the state rows it changed below a folder named after the
    batch, so a repeated batch replaces itself; the newest row of a digest has the
    greatest count and keeper.
    """
    out, checkpoint = scratch_path(spark, "digests"), scratch_path(spark, "digest-stream")
    arriving = spark.readStream.schema(ARRIVAL).option("maxBytesPerTrigger", str(batch_bytes)).parquet(path)
    state = arriving.groupBy("digest", "digest_size").agg(
        F.max(F.struct("doc_id", "uid", "text_key")).alias("keeper"), F.count(F.lit(1)).alias("n")
    )

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    with _settings(spark, STREAM_SETTINGS):
        query = (
            state.writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    changes = spark.read.schema(state.schema).parquet(f"{out}/batch=*")
    return changes.groupBy("digest", "digest_size").agg(F.max("keeper").alias("keeper"), F.max("n").alias("n"))


def _by_bytes(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits grouped by their full normalised bytes. Equal copies meet in the partial
    aggregation of their own task before any text is shuffled."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lowered = pa.array([normalised(t) for t in texts(batch.column("text"))], pa.binary())
        names = ["uid", "doc_id", "text_key", "digest", "digest_size", "body"]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:-1]), lowered], names=names)

    left = narrow(docs).withColumn("_key", text_key()).withColumnRenamed("doc_id", "_id")
    located = left.join(hits, left["_id"].eqNullSafe(hits["doc_id"]) & (left["_key"] == hits["text_key"]))
    return over_batches(located, work, ARRIVAL + ", body binary")


def deduplicate(docs: DataFrame, digest=sha256, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest, text_key.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row
    with the greatest doc_id stays (a null id is the smallest); of rows that repeat both
    id and text, one stays and the others are dropped. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows, path = arrivals(docs, digest)
    state = stream_state(spark, path, batch_bytes)
    state_path = scratch_path(spark, "digest-state")
    state.write.parquet(state_path)
    state = spark.read.schema(state.schema).parquet(state_path)
    key = ["digest", "digest_size"]
    repeated = state.filter("n > 1")
    hits = rows.join(repeated.select(*key), key, "left_semi")
    # rows that repeat id and text share a locator: their bytes are the same row of docs twice
    bodies = _by_bytes(docs, hits.dropDuplicates(["doc_id", "text_key"]))
    different = bodies.groupBy(*key, "body").agg(F.count(F.lit(1)).alias("n")).groupBy(*key).count().filter("count > 1")
    different_path = scratch_path(spark, "digest-collisions")
    different.select(*key).write.parquet(different_path)
    different = spark.read.schema("digest binary, digest_size int").parquet(different_path)
    if not different.isEmpty():
        return _split_collisions(docs, rows, state, different, key)
    found = rows.join(state, key)
    return _result(found)


def _result(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("uid") == F.col("keeper.uid")).alias("kept"), "digest", "text_key",
    )


def _split_collisions(docs: DataFrame, rows: DataFrame, state: DataFrame, different: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose digest covers several texts are grouped by the text itself."""
    plain = rows.join(state.join(different, key, "left_anti"), key)
    located = _by_bytes(docs, rows.join(different, key, "left_semi").dropDuplicates(["doc_id", "text_key"]))
    named = located.select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), *key,
        F.dense_rank().over(Window.partitionBy(*key).orderBy("body")).alias("variant"),
    )
    inside = rows.join(different, key, "left_semi").join(named, key)
    inside = inside.filter(F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).drop("_id", "_key")
    groups = inside.groupBy(*key, "variant").agg(
        F.max(F.struct("doc_id", "uid", "text_key")).alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    return _result(plain).unionByName(_result(inside.join(groups, [*key, "variant"])))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of documents."""
    kept = deduplicate(docs).filter("kept")
    return rows_back(docs, kept.select("doc_id", "text_key"))


def query(docs: DataFrame) -> DataFrame:
    found = deduplicate(docs)
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )

"""How tables lie in files: partition fields, pruning, compaction, retention."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import contracts as C
from stocktide.functions.times import stable_bucket
from stocktide.session import pin
from stocktide.sources.writers import balanced


def write_by(df: DataFrame, path: str, **fields: Column) -> None:
    """Rows in folders by copies of their partition fields, so the files keep every column."""
    folders = {f"_by_{name}": value for name, value in fields.items()}
    laid = balanced(df.withColumns(folders), *folders) if folders else df
    writer = laid.write.mode("overwrite")
    (writer.partitionBy(*folders) if folders else writer).parquet(path)


def read_together(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Folders written by different fields as one table; files of an older layout stay as they are."""
    parts = [spark.read.parquet(path) for path in paths]
    plain = [part.drop(*[c for c in part.columns if c.startswith("_by_")]) for part in parts]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), plain)


def bucket_counts(df: DataFrame, column: str, buckets: int = C.BUCKETS) -> DataFrame:
    return df.groupBy(stable_bucket(F.col(column), buckets).cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def spread_out(df: DataFrame, partitions: int) -> DataFrame:
    """More partitions: a full shuffle."""
    return df.repartition(partitions)


def narrowed(df: DataFrame, partitions: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(partitions)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def compact(spark: SparkSession, source: str, target: str, partition_by: list[str], sort_by: list[str]) -> None:
    """Rewrite small files into a new folder: rebalanced to the advisory size, sorted inside."""
    table = balanced(spark.read.parquet(source), *partition_by)
    writer = table.sortWithinPartitions(*partition_by, *sort_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)


def file_sizes(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    """Every file of a table with its folder, size and number of rows."""
    table = spark.read.schema(schema).parquet(path)
    named = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")]
    return table.groupBy(*folders, *named).agg(F.count(F.lit(1)).alias("rows"))


def compact_small(
    spark: SparkSession, path: str, schema: T.StructType, folders: list[str], sort_by: list[str],
    target_bytes: int = C.TARGET_FILE_BYTES, small_below: float = 0.5,
) -> DataFrame:
    """Write the folders anew that hold two or more small files, in files of about the target size. Returns these
    folders with their bytes; all other folders keep their files.

    Pieces of a folder follow from its size, so a large folder is many tasks and a small one is one file. A folder
    is replaced when all its new files are there.
    """
    files = file_sizes(spark, path, schema, folders)
    sizes = files.groupBy(*folders).agg(
        F.count_if(F.col("file_size") < small_below * target_bytes).alias("small"), F.sum("file_size").alias("bytes")
    )
    chosen = pin(sizes.where("small > 1"))
    if chosen.isEmpty():
        return chosen
    pieces = chosen.select(*folders, F.ceil(F.col("bytes") / target_bytes).cast("int").alias("_pieces")).alias("c")
    same = reduce(and_, (F.col(f"t.{f}").eqNullSafe(F.col(f"c.{f}")) for f in folders))
    rows = spark.read.schema(schema).parquet(path).alias("t").join(pieces, same).select("t.*", "_pieces")
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(*sort_by), F.col("_pieces")))
    laid = dealt.repartition(*folders, "_piece").sortWithinPartitions(*folders, "_piece", *sort_by).select(*schema.names)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    return chosen


def pruning_report(df: DataFrame) -> dict[str, str | int]:
    """What the scan of a filtered table was able to skip: partition filters, filters pushed
    to the files, columns read, and the number of files left."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )

    def found(label: str) -> str:
        hit = re.search(rf"{label}: (.*)", plan)
        return hit.group(1).strip() if hit else ""

    return {
        "partition_filters": found("PartitionFilters"),
        "pushed_filters": found("PushedFilters"),
        "read_schema": found("ReadSchema"),
        "files": len(df.inputFiles()),
    }


def retain_recent(df: DataFrame, as_of: Column, days: int = C.KEEP_RAW_DAYS, day_column: str = "date") -> DataFrame:
    """Rows of the last ``days`` days before a date; on a partition column this prunes."""
    return df.where(F.col(day_column).cast("date") >= F.date_sub(as_of.cast("date"), days))


def drop_days_before(spark: SparkSession, table: str, day: str, day_column: str = "date") -> int:
    """Drop the day partitions of a catalog table that are older than a day."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").where(
        F.regexp_extract("partition", rf"(?:^|/){day_column}=([^/]+)", 1) < day
    )
    old = sorted({re.search(rf"(?:^|/){day_column}=([^/]+)", r["partition"]).group(1) for r in listed.collect()})
    for value in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day_column}='{value}')")
    return len(old)

"""Writing tables and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide import contracts as C


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Bring equal keys together for writing, but split what is too big for one task.

    ``REBALANCE`` differs from ``repartition(key)``: adaptive execution cuts a hot key (or
    a block of equal rows) into several tasks and merges small ones.
    """
    return df.hint("rebalance", *keys) if keys else df.hint("rebalance")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, replacing the folder; as many files as there are tasks."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, mode: str, partition_by: list[str] | None = None) -> None:
    """Parquet table; ``mode`` is always spelled out: ``overwrite`` or ``append``."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode has to be overwrite or append")
    if partition_by:
        df = balanced(df, *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_clustered(df: DataFrame, path: str, day: Column, cluster_by: list[str], day_column: str = "date") -> None:
    """Create and load: one folder per day, rows sorted inside files so that the min/max of
    row groups can skip blocks for a cluster key."""
    dated = df.withColumn(day_column, day)
    (
        balanced(dated, day_column)
        .sortWithinPartitions(day_column, *cluster_by)
        .write.mode("overwrite")
        .partitionBy(day_column)
        .parquet(path)
    )


def replace_days(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; running it twice changes nothing."""
    (
        balanced(df, *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_bucketed(spark: SparkSession, df: DataFrame, name: str, keys: list[str], buckets: int = C.JOIN_BUCKETS) -> DataFrame:
    """A catalog table in buckets of its keys, sorted inside. Joins and groupings by these keys need no shuffle."""
    dealt = df.repartition(buckets, *keys)  # one file for each bucket
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def create_table(spark: SparkSession, name: str, columns: str, partition_by: list[str] | None = None) -> None:
    """Create if absent."""
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}")


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def insert_rows(df: DataFrame, name: str) -> None:
    """Append query rows to a catalog table, matching columns by name."""
    target = df.sparkSession.table(name).columns
    df.select(*target).write.insertInto(name)


def replace_table(df: DataFrame, name: str) -> None:
    """Rebuild a derived catalog table from a query."""
    df.write.mode("overwrite").saveAsTable(name)


def appended(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Table with rows added; columns that one side lacks read as null."""
    return table.unionByName(rows, allowMissingColumns=True)


def with_day(df: DataFrame, ts: str = "ts", name: str = "date") -> DataFrame:
    return df.withColumn(name, F.to_date(ts))

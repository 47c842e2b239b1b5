"""Reading tables, CSV files and message folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = "value binary, attributes map<string,string>, publish_time timestamp"

MOVIES_SCHEMA = "movieId int, title string, genres string, year int, rating double"
RATINGS_SCHEMA = "userId int, movieId int, rating double"
SENSOR_SCHEMA = "device_id int, temperature double, humidity double, status string"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header line. A declared schema saves the extra pass that inference costs."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def external_csv(spark: SparkSession, name: str, path: str, schema: str) -> DataFrame:
    """A named table over CSV files in place: declared columns, header lines skipped."""
    quoted = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING csv OPTIONS (path '{quoted}', header 'true')"
    )
    return spark.table(name)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or Parquet files by path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.read.table(name_or_path)


def shared_view(spark: SparkSession, name: str, path: str) -> None:
    """A second reader over the files of a curated table, without copying them."""
    quoted = path.replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} USING parquet OPTIONS (path '{quoted}')")


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer pieces than there are cores.

    A file with one large row group is one task, however costly the expressions on it are.
    A table with enough pieces is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(stream: DataFrame) -> DataFrame:
    """Deal out the messages of every micro-batch to all cores; its few files would be as few tasks."""
    return stream.repartition(stream.sparkSession.sparkContext.defaultParallelism)


def explore(df: DataFrame, rows: int = 5) -> tuple[str, list, int]:
    """Schema text, a few rows and the row count; never the whole table."""
    return df.schema.treeString(), df.take(rows), df.count()


def read_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Unbounded source over a topic folder of Parquet messages, oldest file first."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_text_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Unbounded source over folders of JSON lines, one message per line."""
    reader = spark.readStream.schema("value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(path)
    return lines.select(
        F.encode("value", "UTF-8").alias("value"),
        F.lit(None).cast("map<string,string>").alias("attributes"),
        F.current_timestamp().alias("publish_time"),
    )


def read_broker(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Unbounded source over a Kafka topic; needs the Kafka connector on the class path."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .options(**options)
        .load()
    )
    return records.select("value", last_of_each(F.col("headers")).alias("attributes"), F.col("timestamp").alias("publish_time"))


def last_of_each(headers: Column) -> Column:
    """Headers (key, value) as a map; of a repeated name the last value counts."""
    names = F.array_distinct(F.transform(headers, lambda h: h["key"]))
    values = F.transform(
        names, lambda name: F.element_at(F.filter(headers, lambda h: h["key"] == name), -1)["value"].cast("string")
    )
    return F.map_from_arrays(names, values)

"""Columns that change over time.

Files of different ages are read under one declared schema, so a column that a file lacks reads null
and nothing is inferred. A column is renamed where the table is read, and dropped by rewriting the files, so
that a column added later under its name starts empty. Catalog tables change by statements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.sources.writers import balanced


def with_column(schema: T.StructType, name: str, kind: str, comment: str = "") -> T.StructType:
    """A declared schema with a nullable column at the end."""
    if name in schema.names:
        raise KeyError(f"column {name} exists")
    type_ = T.StructType.fromDDL(f"c {kind}")["c"].dataType
    return T.StructType([*schema, T.StructField(name, type_, True, {"comment": comment} if comment else {})])


def read_declared(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Files of any age under one schema; only its columns are read."""
    return spark.read.schema(schema).parquet(*paths)


def renamed(df: DataFrame, name: str, new: str, comment: str = "") -> DataFrame:
    if name not in df.columns or new in df.columns:
        raise KeyError(f"column {name} cannot become {new}")
    return df.select(
        *[F.col(c).alias(new, metadata={"comment": comment}) if c == name else F.col(c) for c in df.columns]
    )


def rewritten_without(spark: SparkSession, paths: list[str], schema: T.StructType, target: str, name: str) -> T.StructType:
    """The files of a table written anew without a column, and their schema."""
    kept = T.StructType([f for f in schema if f.name != name])
    if len(kept) == len(schema):
        raise KeyError(f"there is no column {name}")
    balanced(read_declared(spark, paths, kept)).write.mode("overwrite").parquet(target)
    return kept


def add_table_column(spark: SparkSession, table: str, name: str, kind: str, comment: str = "") -> None:
    """For a catalog table: a nullable column at the end."""
    note = f" COMMENT '{comment}'" if comment else ""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {kind}{note})")


def comment_table_column(spark: SparkSession, table: str, name: str, comment: str) -> None:
    spark.sql(f"ALTER TABLE {table} ALTER COLUMN {name} COMMENT '{comment}'")

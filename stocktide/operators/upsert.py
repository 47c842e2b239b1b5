"""Merge, update and delete as plain joins and projections.

A target with one row per key is merged by one full outer join, which computes both sides
once. Any other target is merged by a left join (changed and kept target rows) plus an
anti join (new rows): adaptive execution can split a hot target key there, which it cannot
do for a full outer join, and a small source can be broadcast. Both give the same rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT, _MINE = "_hit", "_mine"


def single_row_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source, failing at run time when a key occurs twice or is null.

    Grouping with partial counts finds the repeats without gathering them in one task.
    """
    rest = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(F.lit(1).alias("_one"), *rest)).alias("_row")
    )
    checked = grouped.where(
        F.when(F.col("_n") > 1, F.raise_error(F.lit("a merge key occurs twice in the source")).cast("boolean"))
        .otherwise(F.lit(True))
    )
    checked = without_null_keys(checked, keys)
    return checked.select(*[F.col(k) if k in keys else F.col(f"_row.{k}").alias(k) for k in source.columns])


def without_null_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source, failing at run time when a key is null: such a row would be inserted anew by every run."""
    key_is_null = reduce(or_, (F.col(key).isNull() for key in keys))
    return source.where(
        F.when(key_is_null, F.raise_error(F.lit("a merge key is null in the source")).cast("boolean")).otherwise(F.lit(True))
    )


def _matches(target: DataFrame, source: DataFrame, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (target[key] == source[f"_s_{key}"])
    return condition


def _prefixed(source: DataFrame) -> DataFrame:
    return source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias(_HIT))


def not_matched(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows without a target row (the insert branch)."""
    return source.join(target.select(*keys), keys, "left_anti")


def matched(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows with a target row (the update branch)."""
    return source.join(target.select(*keys), keys, "left_semi")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: dict[str, str],
    insert: dict[str, str] | None = None,
    newer: tuple[str, str] | None = None,
    source_is_unique: bool = False,
    target_is_unique: bool = False,
) -> DataFrame:
    """Upsert ``source`` into ``target`` on equal keys.

    ``update`` and ``insert`` map target columns to source columns. ``newer`` names a
    (target, source) pair of columns; a match is then applied only if the source value is
    greater, so a late source row cannot overwrite a newer state. ``target_is_unique`` says that no key has
    many target rows; it chooses the plan and never changes the result.
    """
    source = without_null_keys(source, keys) if source_is_unique else single_row_per_key(source, keys)
    insert = insert if insert is not None else {**{k: k for k in keys}, **update}
    side, kinds = _prefixed(source), dict(target.dtypes)
    mine = target.withColumn(_MINE, F.lit(True))
    joined = mine.join(side, _matches(mine, side, keys), "full_outer" if target_is_unique else "left")
    apply = F.col(_HIT).isNotNull()
    if newer:
        own, theirs = newer
        apply = apply & (F.col(own).isNull() | (F.col(f"_s_{theirs}") > F.col(own)))

    def value(column: str, given: dict[str, str], prefix: str) -> Column:
        found = F.col(f"{prefix}{given[column]}") if column in given else F.lit(None)
        return found.cast(kinds[column])

    merged = joined.select(*[
        F.when(F.col(_MINE).isNull(), value(c, insert, "_s_"))
        .when(apply if c in update else F.lit(False), value(c, update, "_s_"))
        .otherwise(F.col(c)).alias(c)
        for c in target.columns
    ])
    if target_is_unique:
        return merged
    fresh = not_matched(source, target, keys).select(*[value(c, insert, "").alias(c) for c in target.columns])
    return merged.unionByName(fresh)


def merge_sql(spark, target: str, source: str, keys: list[str], update: dict[str, str], insert: dict[str, str]) -> None:
    """The same as one ``MERGE INTO``, for catalogs whose tables support row-level changes."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"t.{a} = s.{b}" for a, b in update.items())
    columns, values = ", ".join(insert), ", ".join(f"s.{b}" for b in insert.values())
    spark.sql(
        f"MERGE INTO {target} t USING {source} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({values})"
    )


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns where the condition holds; where it is null the row stays as it is."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.when(condition, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in changes.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows where the condition holds; where it is null the row is kept."""
    return df.where(~F.coalesce(condition, F.lit(False)))

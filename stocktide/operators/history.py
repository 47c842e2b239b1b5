"""Time travel over a change log.

A change log is a DataFrame (normally Parquet, one folder per version) with the data
columns plus

* ``_version``  increasing number of the commit,
* ``_op``       ``upsert`` or ``delete``,
* ``_seq``      order of changes of one key inside a version.

Times of versions come from a table of commits (``version, committed_at, ...``), which a
log that carries its times can be summed up to (``commit_summary``).

States are partial aggregates over the log (see ``latest``), so a key with very many
changes is reduced before the shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import contracts as C
from stocktide.operators.latest import latest_per_key
from stocktide.operators.ordered import running_total
from stocktide.sources.writers import replace_days

UPSERT, DELETE = "upsert", "delete"
_META = ["_version", "_op", "_seq"]


# -- states ------------------------------------------------------------------


def _data(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in _META]


def as_of_version(changes: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Table state at a version; the range on ``_version`` prunes folders of the log."""
    seen = changes.where(F.col("_version") <= version)
    newest = latest_per_key(seen, keys, [F.col("_version"), F.col("_seq")])
    return newest.where(F.col("_op") != DELETE).select(*_data(changes))


def current(changes: DataFrame, keys: list[str]) -> DataFrame:
    newest = latest_per_key(changes, keys, [F.col("_version"), F.col("_seq")])
    return newest.where(F.col("_op") != DELETE).select(*_data(changes))


def version_at(commits: DataFrame, moment: datetime | str | int) -> int:
    """Last version committed at or before a moment (timestamp, its text, or epoch millis)."""
    at = F.timestamp_millis(F.lit(moment)) if isinstance(moment, int) else F.lit(moment).cast("timestamp")
    found = commits.where(F.col("committed_at").cast("timestamp") <= at).agg(F.max("version").alias("v")).first()["v"]
    if found is None:
        raise ValueError(f"there is no version at or before {moment}")
    return found


def check_version(commits: DataFrame, version: int) -> int:
    if commits.where(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version} does not exist")
    return version


def as_of_time(changes: DataFrame, commits: DataFrame, keys: list[str], moment: datetime | str | int) -> DataFrame:
    return as_of_version(changes, keys, version_at(commits, moment))


def version_diff(changes: DataFrame, keys: list[str], old: int, new: int) -> DataFrame:
    """Rows added, removed or changed between two versions.

    Both states come from one pass over the log: two conditional maxima per key instead of
    two states and a join. ``change`` is added, removed or changed; ``before`` and
    ``after`` hold the rows.
    """
    rest = [c for c in _data(changes) if c not in keys]
    entry = F.struct("_version", "_seq", "_op", F.struct(*rest).alias("row"))

    def state(version: int) -> Column:
        return F.max(F.when(F.col("_version") <= version, entry))

    both = changes.where(F.col("_version") <= max(old, new)).groupBy(*keys).agg(
        state(old).alias("_a"), state(new).alias("_b")
    )

    def row(name: str) -> Column:
        return F.when(F.col(f"{name}._op") != DELETE, F.col(f"{name}.row"))

    pairs = both.select(*keys, row("_a").alias("before"), row("_b").alias("after"))
    change = (
        F.when(F.col("before").isNull() & F.col("after").isNotNull(), "added")
        .when(F.col("before").isNotNull() & F.col("after").isNull(), "removed")
        .when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    )
    return pairs.withColumn("change", change).where(F.col("change").isNotNull())


def rollback_changes(changes: DataFrame, keys: list[str], now: int, to: int) -> DataFrame:
    """The changes that, committed as version ``now + 1``, bring back the state of ``to``."""
    diff = version_diff(changes, keys, now, to)
    rest = [c for c in _data(changes) if c not in keys]
    gone = F.col("change") == "removed"
    picked = F.when(gone, F.col("before")).otherwise(F.col("after"))
    out = diff.select(
        *keys,
        *[picked[c].alias(c) for c in rest],
        F.lit(now + 1).cast(dict(changes.dtypes)["_version"]).alias("_version"),
        F.when(gone, DELETE).otherwise(UPSERT).alias("_op"),
        F.lit(0).cast(dict(changes.dtypes)["_seq"]).alias("_seq"),
    )
    return out.select(*changes.columns)


def expire(changes: DataFrame, keys: list[str], keep_from: int) -> DataFrame:
    """Fold everything up to ``keep_from`` into one base; that version and all later ones
    still read the same, older ones are gone."""
    base = as_of_version(changes, keys, keep_from).select(
        "*",
        F.lit(keep_from).cast(dict(changes.dtypes)["_version"]).alias("_version"),
        F.lit(UPSERT).alias("_op"),
        F.lit(0).cast(dict(changes.dtypes)["_seq"]).alias("_seq"),
    )
    later = changes.where(F.col("_version") > keep_from)
    return base.select(*changes.columns).unionByName(later)


def expire_older(
    changes: DataFrame, commits: DataFrame, keys: list[str], as_of: str, days: int = C.KEEP_VERSIONS_DAYS
) -> DataFrame:
    """Expire by age: the version that was current ``days`` before ``as_of`` becomes the base.
    Nothing happens while the whole history is younger than that."""
    limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    old = commits.where(F.col("committed_at").cast("timestamp") <= limit)
    base = old.agg(F.max("version").alias("v")).first()["v"]
    return changes if base is None else expire(changes, keys, base)


# -- changes made by row-level statements ----------------------------------------


def update_changes(state: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Only the rows an update touches, as upserts."""
    kinds = dict(state.dtypes)
    hit = state.where(F.coalesce(condition, F.lit(False)))
    return hit.withColumns({c: v.cast(kinds[c]) for c, v in values.items()}).withColumn("_op", F.lit(UPSERT))


def delete_changes(state: DataFrame, condition: Column) -> DataFrame:
    """Only the rows a delete touches, as tombstones."""
    return state.where(F.coalesce(condition, F.lit(False))).withColumn("_op", F.lit(DELETE))


def keyed_rows(df: DataFrame, version: int, name: str = "_key") -> DataFrame:
    """A row key for tables without one: version, hash of the row, and a running number
    among equal rows. Equal rows are first counted and then numbered, so a large group
    of copies is expanded where it is needed and never gathered."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / 10_000))
    blocked = counted.withColumn("_hash", F.sha2(text, 256)).withColumn("_block", F.explode(blocks))
    spread = blocked.hint("rebalance")
    first = F.col("_block") * 10_000
    last = F.least(first + 9_999, F.col("_copies") - 1)
    return spread.withColumn("_ordinal", F.explode(F.sequence(first, last))).select(
        *df.columns, F.concat_ws(":", F.lit(version), "_hash", "_ordinal").alias(name)
    )


# -- a log in folders ------------------------------------------------------------


def write_changes(changes: DataFrame, path: str) -> None:
    """Changes into the folders of their versions. A rerun replaces exactly the versions it has."""
    replace_days(changes, f"{path}/changes", ["_version"])


def read_changes(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/changes")


def fold_base(spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], version: int) -> int:
    """Write the state at a version as a base, folded from the base before it and the changes since, and
    return the number of log rows that no reader of that or a later version needs any more."""
    base = stored_version(spark, path, schema, keys, version).withColumn("_version", F.lit(version).cast("bigint"))
    replace_days(base, f"{path}/base", ["_version"])
    return read_changes(spark, path, schema).where(F.col("_version") <= version).count()


def newest_base(spark: SparkSession, path: str, version: int) -> int:
    """The newest folded version up to ``version``, 0 where there is none. Reads folder names only."""
    try:
        bases = spark.read.schema("_version bigint").option("recursiveFileLookup", False).parquet(f"{path}/base")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return bases.where(F.col("_version") <= version).agg(F.max("_version")).first()[0] or 0


def stored_version(spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], version: int) -> DataFrame:
    """State at a version from the newest base up to it and the folders after that base; no others are read."""
    changes = read_changes(spark, path, schema)
    base = newest_base(spark, path, version)
    later = changes.where(F.col("_version").between(base + 1, version))
    if base:
        kinds = dict(changes.dtypes)
        data = T.StructType([f for f in changes.schema if f.name not in ("_op", "_seq")])
        folded = spark.read.schema(data).parquet(f"{path}/base").where(F.col("_version") == base)
        folded = folded.withColumns({"_op": F.lit(UPSERT), "_seq": F.lit(0).cast(kinds["_seq"])})
        later = later.unionByName(folded)
    newest = latest_per_key(later, keys, [F.col("_version"), F.col("_seq")])
    return newest.where(F.col("_op") != DELETE).select(*_data(changes))


# -- listings ------------------------------------------------------------------


def commit_summary(changes: DataFrame, ts: str, *same: str) -> DataFrame:
    """Commit rows derived from a log that carries its times; columns ``same`` have one value per version."""
    return changes.groupBy(F.col("_version").alias("version"), *same).agg(
        F.max(ts).alias("committed_at"),
        F.count_if(F.col("_op") == UPSERT).alias("upserts"),
        F.count_if(F.col("_op") == DELETE).alias("deletes"),
    )


def snapshot_log(commits: DataFrame, added: str = "added_rows") -> DataFrame:
    """Commits with the running number of rows."""
    return running_total(commits, [F.col("version")], added, "total_rows")


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Data files of a Parquet table with format, partition folder and number of records."""
    table = spark.read.parquet(path)
    root = path.rstrip("/").split("://")[-1]
    inside = F.substring_index("file_path", f"{root}/", -1)
    return (
        table.groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select("file_path", F.lit("PARQUET").alias("file_format"), F.regexp_replace(inside, "/?[^/]+$", "").alias("partition"), "record_count")
    )

"""Every operator as a query over the benchmark tables.

Each function takes the session and the folder of the tables and returns a DataFrame.
Ties and times are made explicit so that results repeat.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide import contracts as C
from stocktide.functions.numeric import mean, settled
from stocktide.functions.times import ago, event_time, iso_text, spread_day, stable_bucket, written_day
from stocktide.operators import aggregates as A
from stocktide.operators import basics as B
from stocktide.operators import contract_check as K
from stocktide.operators import curation as U
from stocktide.operators import evolve as E
from stocktide.operators import history as H
from stocktide.operators import latest as L
from stocktide.operators import layout as Y
from stocktide.operators import lateness, ordered, quality, upsert
from stocktide.operators import validate as V
from stocktide.operators import windows as W
from stocktide.plans import samples as S
from stocktide.plans.curated import run_curated
from stocktide.session import scratch_path, staged
from stocktide.sources import messages as M
from stocktide.sources import readers as R
from stocktide.sources import writers as O
from stocktide.streaming import checked, ingest, state

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

KEYS = ["store_id", "product_id"]
CUT = "1998-06-01"
MEAN_PLACES, MONEY_PLACES = 6, 4


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _local(df: DataFrame, *columns: str) -> DataFrame:
    """Times without zone, as the tables hold them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _in_utc(column: str):
    """An instant as UTC time without zone, whatever the session's time zone is."""
    return F.convert_timezone(None, F.lit("UTC"), F.col(column))


def _utc(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: _in_utc(c) for c in columns})


def _dated(spark: SparkSession, d: str) -> DataFrame:
    return O.with_day(S.telemetry(spark, d))


def _sales(spark: SparkSession, d: str) -> DataFrame:
    return A.sales_daily(S.raw_orders(spark, d, customers=False))


def _settled(df: DataFrame, *columns: str, places: int = MEAN_PLACES) -> DataFrame:
    """Final results in stated places, so that they do not depend on the order of summing."""
    return df.withColumns({c: settled(F.col(c), places) for c in columns})


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return _settled(df, *columns, places=MONEY_PLACES)


# -- sources and sinks -----------------------------------------------------------


@query
def scan_count(spark, d):
    return S.table(spark, d, "events").agg(F.count(F.lit(1)).alias("rows"))


@query
def csv_round_trip(spark, d):
    path = scratch_path(spark, "csv")
    O.write_csv(S.telemetry(spark, d).select("device_id", "temperature", "humidity", "status"), path)
    return R.read_csv(spark, path, R.SENSOR_SCHEMA).select(
        F.col("device_id").cast("bigint").alias("device_id"), "temperature", "humidity", "status"
    )


def _table_name(spark, label: str) -> str:
    return f"{label}_{scratch_path(spark, label)[-32:]}"


@query
def external_csv_rows(spark, d):
    """A named table over CSV files that stay where they are."""
    path = scratch_path(spark, "external")
    O.write_csv(S.telemetry(spark, d).select("device_id", "temperature", "humidity", "status"), path)
    rows = R.external_csv(spark, _table_name(spark, "external"), path, R.SENSOR_SCHEMA)
    return rows.withColumn("device_id", F.col("device_id").cast("bigint"))


@query
def insert_into_created(spark, d):
    """Created once although asked for twice, then filled by name from two queries."""
    name, daily = _table_name(spark, "stats"), A.device_daily(S.telemetry(spark, d))
    for _ in range(2):
        O.create_table(spark, name, "device_id string, reading_count bigint, avg_temperature double, date string", ["date"])
    for part in ("date < '2024-01-10'", "date >= '2024-01-10'"):
        O.insert_rows(daily.where(part), name)
    return _settled(spark.table(name), "avg_temperature")


@query
def replaced_report(spark, d):
    """A derived table built twice; the second build takes the place of the first."""
    name, daily = _table_name(spark, "report"), A.device_daily(S.telemetry(spark, d))
    for part in ("date < '2024-01-10'", "date >= '2024-01-10'"):
        O.replace_table(daily.where(part).select("device_id", "date", "reading_count"), name)
    return spark.table(name)


@query
def shared_view_rows(spark, d):
    """Rows appended after a view was made are seen through it."""
    path, name, rows = scratch_path(spark, "shared"), _table_name(spark, "view"), S.telemetry(spark, d)
    O.write_table(rows.where("status = 'OK'"), path, "overwrite")
    R.shared_view(spark, name, path)
    O.write_table(rows.where("status <> 'OK'"), path, "append")
    spark.sql(f"REFRESH TABLE {name}")
    return spark.table(name)


@query
def column_added_to_table(spark, d):
    """A catalog table that gets a described column; rows from before read null there."""
    name, rows = _table_name(spark, "growing"), S.telemetry(spark, d).select("event_id", "status")
    O.create_table(spark, name, "event_id bigint, status string")
    O.insert_rows(rows.where("status = 'OK'"), name)
    E.add_table_column(spark, name, "remark", "string", "Set by hand")
    E.comment_table_column(spark, name, "remark", "Status of the reading")
    O.insert_rows(rows.where("status <> 'OK'").withColumn("remark", F.lower("status")), name)
    comment = spark.table(name).schema["remark"].metadata["comment"]
    return spark.table(name).withColumn("described", F.lit(comment))


@query
def dropped_tables(spark, d):
    """What a schema still holds after one of its tables was dropped, taken before the schema goes too."""
    schema, rows = _table_name(spark, "shop"), S.telemetry(spark, d)
    O.create_schema(spark, schema)
    for table, part in (("kept", "status = 'OK'"), ("gone", "status <> 'OK'")):
        O.replace_table(rows.where(part), f"{schema}.{table}")
    O.drop_table(spark, f"{schema}.gone")
    left = [spark.table(f"{schema}.{t.name}").withColumn("table", F.lit(t.name)) for t in spark.catalog.listTables(schema) if not t.isTemporary]
    counts = staged(reduce(DataFrame.unionByName, left).groupBy("table").agg(F.count(F.lit(1)).alias("rows")), "left")
    O.drop_schema(spark, schema)
    return counts.withColumn("schema_exists", F.lit(spark.catalog.databaseExists(schema)))


@query
def clustered_read(spark, d):
    path = scratch_path(spark, "clustered")
    O.write_clustered(S.telemetry(spark, d), path, F.to_date("ts"), ["device_id"])
    rows = B.on_day(spark.read.parquet(path), "2024-01-10", "device_id", "3")
    return rows.select("event_id", "device_id", "ts", "temperature", "status")


@query
def insert_append(spark, d):
    """Rows of daily device statistics appended to a table that lacks one of their columns."""
    daily = A.device_daily(S.telemetry(spark, d))
    base, more = daily.where("date < '2024-01-20'").drop("avg_humidity"), daily.where("date >= '2024-01-20'")
    return _settled(O.appended(base, more), "avg_temperature", "avg_humidity")


@query
def table_append_mode(spark, d):
    path = scratch_path(spark, "mode")
    daily = A.device_daily(S.telemetry(spark, d))
    O.write_table(daily, path, "overwrite")
    O.write_table(daily, path, "append")
    return _settled(R.read_table(spark, path), "avg_temperature", "avg_humidity")


@query
def days_replaced(spark, d):
    """Daily sales in month folders, written twice: the second time only the months from 1998
    on, with zero revenue."""
    path = scratch_path(spark, "months")
    sales = _sales(spark, d).withColumn("month", F.substring("date", 1, 7))
    O.replace_days(sales, path, ["month"])
    zeroed = sales.where(F.col("date") >= "1998-01-01").withColumn("total_revenue", F.lit(0.0))
    O.replace_days(zeroed, path, ["month"])
    return _money(spark.read.parquet(path).drop("month"), "total_revenue")


@query
def encode_events(spark, d):
    encoded = M.encode_events(S.telemetry(spark, d), S.utc_text("ts"))
    return encoded.select(
        F.decode("value", "UTF-8").alias("value"),
        F.col("attributes")["device_id"].alias("device_id"),
        F.col("attributes")["timestamp"].alias("stamp"),
    )


@query
def json_encode(spark, d):
    messages = W.window_messages(W.device_windows(S.telemetry(spark, d), "1 hour"))
    return messages.select(F.decode("value", "UTF-8").alias("value"))


# -- projection, filter, order -----------------------------------------------------


@query
def project(spark, d):
    return S.movies(spark, d).select("title", "year", "rating")


@query
def filter_year(spark, d):
    return S.movies(spark, d).where(F.col("year") >= 2000)


@query
def filter_rating(spark, d):
    return S.ratings(spark, d).where(F.col("rating") >= 4.0)


@query
def filter_anomaly(spark, d):
    return S.telemetry(spark, d).where(F.col("status") != C.OK_STATUS)


@query
def low_stock(spark, d):
    return U.latest_inventory(S.raw_inventory(spark, d), ["seq"]).where(F.col("quantity_on_hand") < 10)


@query
def low_stock_report(spark, d):
    """What has to be ordered again, least stock first."""
    low = _stock(spark, d).where(F.col("quantity_on_hand") < 10)
    return low.select(*KEYS, "quantity_on_hand", "last_updated").orderBy("quantity_on_hand", *KEYS)


@query
def filter_tier(spark, d):
    return U.latest_customers(S.raw_customers(spark, d), ["seq"]).where(F.col("loyalty_tier") == "PLATINUM")


@query
def completed_orders(spark, d):
    return S.raw_orders(spark, d).where(F.col("status") == C.DEFAULT_ORDER_STATUS)


@query
def high_temp(spark, d):
    return B.above_with_default(S.telemetry(spark, d), "temperature")


@query
def date_device_avg(spark, d):
    rows = S.telemetry(spark, d, only=(F.col("user_id") == 3) & B.within_day("ts", "2024-01-10"))
    return _settled(A.mean_of(rows, "temperature", "avg_temp"), "avg_temp")


@query
def rename_cast(spark, d):
    rows = S.table(spark, d, "events").select("event_id", "user_id", "value")
    return B.renamed(rows, {"user_id": "sensor_id", "value": "temperature"}, {"sensor_id": "string"})


@query
def json_parse(spark, d):
    return V.read_field(S.table(spark, d, "events").select("event_id", "props"), "props", "k", "bigint")


@query
def format_report(spark, d):
    means = S.telemetry(spark, d).groupBy("device_id").agg(mean(F.col("temperature")).alias("m"))
    return B.formatted(means, "device_id", F.col("m"))


@query
def top_rated(spark, d):
    return B.top(
        S.movies(spark, d).select("movieId", "title", "year", "rating"), 5, F.desc("rating"), F.asc("movieId")
    )


@query
def sample_anomalies(spark, d):
    return B.top(S.telemetry(spark, d).where(F.col("status") != C.OK_STATUS), 10, F.asc("event_id"))


@query
def day_spread(spark, d):
    as_of = F.lit("2026-06-10 12:00:00").cast("timestamp_ntz")
    return S.telemetry(spark, d).select(
        "event_id", "device_id", spread_day(as_of, F.col("event_id"), C.SPREAD_DAYS).alias("ts")
    )


@query
def iso_times(spark, d):
    return S.telemetry(spark, d).select(
        "event_id", iso_text(F.col("ts"), "Z").alias("iso"), ago(F.col("ts"), minutes=5).alias("five_minutes_ago")
    )


# -- validation ----------------------------------------------------------------


@query
def validate_orders(spark, d):
    return V.valid(V.tag_orders(S.order_messages(spark, d)))


@query
def validate_orders_compat(spark, d):
    return V.valid(V.tag_orders(S.order_messages(spark, d), compat=True))


@query
def validate_inventory(spark, d):
    return V.valid(V.tag_inventory(S.inventory_messages(spark, d), compat=True))


@query
def validate_inventory_keep_zero(spark, d):
    return V.valid(V.tag_inventory(S.inventory_messages(spark, d), keep_zero=True))


@query
def validate_customers(spark, d):
    return V.valid(V.tag_customers(S.customer_messages(spark, d)))


@query
def filter_ok(spark, d):
    return V.valid(V.tag_telemetry(S.telemetry_messages(spark, d)))


@query
def dead_letter_counts(spark, d):
    return V.outcome_counts(V.tag_orders(S.order_messages(spark, d)))


@query
def rejected_telemetry(spark, d):
    tagged = V.rejected(V.tag_telemetry(S.telemetry_messages(spark, d)))
    return tagged.select(F.decode("value", "UTF-8").alias("value"), "reason")


@query
def contract_violations(spark, d):
    return K.violation_counts(K.with_violations(S.order_messages(spark, d), C.ORDER_CONTRACT))


@query
def contract_violations_inventory(spark, d):
    return K.violation_counts(K.with_violations(S.inventory_messages(spark, d), C.INVENTORY_CONTRACT))


@query
def contract_violations_customers(spark, d):
    return K.violation_counts(K.with_violations(S.customer_messages(spark, d), C.CUSTOMER_CONTRACT))


# -- aggregates ------------------------------------------------------------------


@query
def total_records(spark, d):
    return A.total_records(S.ratings(spark, d))


@query
def genre_avg(spark, d):
    return _settled(A.mean_by(B.exploded(S.movies(spark, d), "genres", "genre"), ["genre"], "rating", "avg_rating"), "avg_rating")


@query
def device_avg(spark, d):
    return _settled(A.mean_by(S.telemetry(spark, d), ["device_id"], "temperature", "temperature"), "temperature")


@query
def user_avg(spark, d):
    return _settled(A.mean_by(S.ratings(spark, d), ["userId"], "rating", "avg_rating"), "avg_rating")


@query
def movie_stats(spark, d):
    return A.count_and_mean_by(S.ratings(spark, d), "movieId", "rating")


@query
def device_summary(spark, d):
    return A.device_summary(S.telemetry(spark, d)).orderBy(F.desc("avg_temp"), "device_id")


@query
def one_device_avg(spark, d):
    return _settled(A.mean_of(S.telemetry(spark, d, only=F.col("user_id") == 3), "temperature", "avg_temp"), "avg_temp")


@query
def device_daily(spark, d):
    return _settled(A.device_daily(S.telemetry(spark, d)), "avg_temperature", "avg_humidity")


@query
def device_avg_since(spark, d):
    return _settled(A.mean_by(B.since(_dated(spark, d), "2024-01-15"), ["device_id"], "temperature", "avg_temp"), "avg_temp")


@query
def sales_daily(spark, d):
    return _money(_sales(spark, d), "total_revenue")


@query
def daily_store_revenue(spark, d):
    return _money(A.store_revenue_by_day(_sales(spark, d)), "daily_revenue")


@query
def store_revenue(spark, d):
    return _money(A.store_revenue(_sales(spark, d)), "revenue").orderBy(F.desc("revenue"), "store_id")


@query
def top_stores(spark, d):
    return B.top(_money(A.store_revenue(_sales(spark, d)), "revenue"), 5, F.desc("revenue"), F.asc("store_id"))


@query
def top_store_days(spark, d):
    """The store days with the greatest revenue; ties go to the earlier day and the smaller store."""
    days = _money(A.store_revenue_by_day(_sales(spark, d)), "daily_revenue")
    return B.top(days, 5, F.desc("daily_revenue"), F.asc("date"), F.asc("store_id"))


@query
def dq_revenue(spark, d):
    revenue = A.store_revenue_by_day(_sales(spark, d))
    return quality.rule_counts(revenue, quality.revenue_rules())


# -- newest rows, ids --------------------------------------------------------------


@query
def latest_inventory(spark, d):
    return U.latest_inventory(S.raw_inventory(spark, d), ["seq"])


@query
def latest_customer(spark, d):
    return U.latest_customers(S.raw_customers(spark, d), ["seq"])


@query
def dedup_orders(spark, d):
    return L.first_per_key(S.raw_orders(spark, d, spread_out=True), ["order_id"], [event_time(F.col("event_time"))])


@query
def numbered_devices(spark, d):
    means = S.table(spark, d, "events").groupBy("user_id").agg(mean(F.col("value")).alias("temperature"))
    ids = ordered.numbered(means, [F.col("user_id")])
    return _settled(ids.select("id", F.col("user_id").cast("string").alias("sensor_id"), "temperature"), "temperature")


@query
def late_flags(spark, d):
    flagged = lateness.late_flags(S.telemetry_arrivals(spark, d), "device_id", "ts", ["arrival", "event_id"], 120)
    return flagged.select("event_id", "device_id", "arrival", "is_late")


# -- joins and merges ----------------------------------------------------------------


def _stock(spark, d):
    rows = U.latest_inventory(S.raw_inventory(spark, d), ["seq"])
    return rows.withColumnRenamed("event_time", "last_updated").drop("seq")


@query
def sales_with_stock(spark, d):
    return _money(U.sales_with_stock(_sales(spark, d), _stock(spark, d)), "total_revenue")


@query
def product_performance(spark, d):
    return _money(U.product_performance(_sales(spark, d), _stock(spark, d)), "total_revenue")


@query
def product_performance_fixed(spark, d):
    return _money(U.product_performance(_sales(spark, d), _stock(spark, d), stock_once=True), "total_revenue")


def _inventory_sides(spark, d, bad):
    """Target and updates from two complementary parts of the events."""
    events = S.raw_inventory(spark, d)
    bad = F.coalesce(bad, F.lit(False))
    target = U.latest_inventory(events.where(~bad), ["seq"]).select(
        "store_id", "product_id", "quantity_on_hand", F.col("event_time").alias("last_updated"), "supplier_id"
    )
    return target, U.latest_inventory(events.where(bad), ["seq"])


@query
def merge_inventory(spark, d):
    target, updates = _inventory_sides(spark, d, F.col("event_time") >= CUT)
    return U.merge_inventory(target, updates)


@query
def merge_guarded(spark, d):
    """Updates by stock level, so that some are older than the target row."""
    target, updates = _inventory_sides(spark, d, F.col("quantity_on_hand") < 25)
    return U.merge_inventory(target, updates, guarded=True)


@query
def merge_inserts(spark, d):
    target, updates = _inventory_sides(spark, d, F.col("event_time") >= CUT)
    return upsert.not_matched(updates, target, KEYS)


@query
def merge_updates(spark, d):
    target, updates = _inventory_sides(spark, d, F.col("event_time") >= CUT)
    return upsert.matched(updates, target, KEYS)


@query
def merge_customer(spark, d):
    events = S.raw_customers(spark, d)
    late = F.col("event_time") >= CUT
    target = U.latest_customers(events.where(~late), ["seq"]).select(
        "customer_id", "first_name", "last_name", "email", "phone", "loyalty_tier",
        F.col("event_time").alias("last_updated_time"),
    )
    return U.merge_customers(target, U.latest_customers(events.where(late), ["seq"]))


@query
def update_where(spark, d):
    return upsert.update_where(S.telemetry(spark, d), F.col("device_id") == "3", {"humidity": F.col("humidity") + 0.5})


@query
def delete_where(spark, d):
    return upsert.delete_where(S.telemetry(spark, d), F.col("temperature") > 30.0)


# -- history ---------------------------------------------------------------------


@query
def snapshot_log(spark, d):
    days = S.table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.max("ts").alias("committed_at"), F.count(F.lit(1)).alias("added_rows")
    )
    commits = ordered.numbered(days, [F.col("day")], "version", 1)
    listed = H.snapshot_log(commits)
    return listed.select(
        "version",
        F.when(F.col("version") > 1, F.col("version") - 1).cast("double").alias("parent"),
        "committed_at", F.lit("append").alias("operation"), "added_rows", "total_rows",
    )


@query
def commit_summary(spark, d):
    changes = S.inventory_changes(spark, d)
    return H.commit_summary(changes, "event_time")


@query
def as_of_version(spark, d):
    return H.as_of_version(S.inventory_changes(spark, d), KEYS, 7)


@query
def as_of_time(spark, d):
    changes = S.inventory_changes(spark, d)
    commits = H.commit_summary(changes.withColumn("at", F.try_to_timestamp("event_time")), "at")
    return H.as_of_time(changes, commits, KEYS, "2000-01-15 00:00:00")


@query
def current_state(spark, d):
    return H.current(S.inventory_changes(spark, d), KEYS)


@query
def version_diff(spark, d):
    diff = H.version_diff(S.inventory_changes(spark, d), KEYS, 7, 8)
    return diff.select(
        *KEYS, "change",
        F.col("before.quantity_on_hand").cast("double").alias("quantity_before"),
        F.col("after.quantity_on_hand").cast("double").alias("quantity_after"),
    )


@query
def expire_keeps_state(spark, d):
    folded = H.expire(S.inventory_changes(spark, d), KEYS, 6)
    return H.as_of_version(folded, KEYS, 8)


@query
def expire_by_age(spark, d):
    """Versions older than a year before a date folded away; the newest state is read."""
    changes = S.inventory_changes(spark, d)
    commits = H.commit_summary(changes.withColumn("moment", F.try_to_timestamp("event_time")), "moment")
    return H.current(H.expire_older(changes, commits, KEYS, "2001-01-15 00:00:00", 365), KEYS)


@query
def rollback_state(spark, d):
    changes = S.inventory_changes(spark, d)
    back = H.rollback_changes(changes, KEYS, 10, 7)
    return H.as_of_version(changes.unionByName(back), KEYS, 11)


def _inventory_log(spark, d):
    """The change log in folders, folded up to its fifth version."""
    path, changes = scratch_path(spark, "log"), S.inventory_changes(spark, d)
    H.write_changes(changes, path)
    return path, changes.schema, H.fold_base(spark, path, changes.schema, KEYS, 5)


@query
def stored_version(spark, d):
    """State at a version from a base and the two folders after it."""
    path, schema, _ = _inventory_log(spark, d)
    return H.stored_version(spark, path, schema, KEYS, 7)


@query
def expired_log(spark, d):
    """What is left of the log once its first versions are folded: rows by version and kind, and rows folded."""
    path, schema, folded = _inventory_log(spark, d)
    changes = H.expire(H.read_changes(spark, path, schema), KEYS, 5)
    counts = changes.groupBy(F.col("_version").alias("version"), F.col("_op").alias("op")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("folded_rows", F.lit(folded).cast("bigint"))


_STEPS = {
    "update": lambda s: H.update_changes(s, F.col("device_id") == "3", {"humidity": F.col("humidity") + 0.5}),
    "delete": lambda s: H.delete_changes(s, F.col("temperature") > 30.0),
}


def _telemetry_log(spark, d, hours: dict[str, int]):
    """An insert, and some statements after it, as versions of a log in folders."""
    path = scratch_path(spark, "log")
    first = S.telemetry(spark, d).withColumns({
        "_version": F.lit(1).cast("bigint"), "_op": F.lit("upsert"), "_seq": F.lit(0).cast("bigint"),
        "committed_at": F.lit("2026-06-10 10:00:00").cast("timestamp"), "operation": F.lit("insert"),
    })
    H.write_changes(first, path)
    for version, (name, hour) in enumerate(hours.items(), start=2):
        state = H.stored_version(spark, path, first.schema, ["event_id"], version - 1)
        made = _STEPS[name](state).withColumns({
            "_version": F.lit(version).cast("bigint"), "_seq": F.lit(0).cast("bigint"),
            "committed_at": F.lit(f"2026-06-10 {hour}:00:00").cast("timestamp"), "operation": F.lit(name),
        })
        H.write_changes(made.select(*first.columns), path)
    return H.read_changes(spark, path, first.schema)


@query
def stored_history(spark, d):
    """The state before the delete, by its time."""
    log = _telemetry_log(spark, d, {"update": 11, "delete": 12})
    commits = H.commit_summary(log, "committed_at")
    return H.as_of_time(log, commits, ["event_id"], "2026-06-10 11:30:00").drop("committed_at", "operation")


@query
def stored_commits(spark, d):
    """The versions of the log."""
    commits = H.commit_summary(_telemetry_log(spark, d, {"delete": 12}), "committed_at", "operation")
    parent = F.when(F.col("version") > 1, F.col("version") - 1).cast("double")
    return _local(commits, "committed_at").withColumn("parent", parent)


@query
def file_records(spark, d):
    """Records per partition folder of a table, from the listing of its files."""
    path = scratch_path(spark, "files")
    O.write_table(S.telemetry(spark, d), path, "overwrite", ["status"])
    files = H.file_inventory(spark, path)
    return files.groupBy("file_format", "partition").agg(F.sum("record_count").alias("record_count"))


# -- columns and layout --------------------------------------------------------------


def _evolved(spark, d):
    """Old files, new files written after a column was added, and the schema since then."""
    old, new = scratch_path(spark, "evolved-old"), scratch_path(spark, "evolved-new")
    rows = S.telemetry(spark, d)
    schema = E.with_column(rows.schema, "remark", "string", "Set by hand")
    rows.where(F.col("status") == "OK").write.parquet(old)
    rows.where(F.col("status") != "OK").withColumn("remark", F.col("status")).write.parquet(new)
    return [old, new], schema


@query
def evolve_add(spark, d):
    return E.read_declared(spark, *_evolved(spark, d))


@query
def evolve_rename(spark, d):
    return E.renamed(E.read_declared(spark, *_evolved(spark, d)), "remark", "notes", "Updated")


@query
def evolve_drop(spark, d):
    """Dropped, then added again: the old values stay away."""
    paths, schema = _evolved(spark, d)
    path = scratch_path(spark, "evolved-dropped")
    kept = E.rewritten_without(spark, paths, schema, path, "remark")
    return E.read_declared(spark, [path], E.with_column(kept, "remark", "string"))


@query
def layout_evolution(spark, d):
    """Rows written without folders, by status and by bucket, read as one table."""
    rows, root = S.telemetry(spark, d), scratch_path(spark, "layouts")
    Y.write_by(rows.where("temperature < 10"), f"{root}/plain")
    Y.write_by(rows.where("temperature >= 10 and temperature < 30"), f"{root}/status", status=F.col("status"))
    Y.write_by(rows.where("temperature >= 30 or temperature is null"), f"{root}/bucket", bucket=stable_bucket(F.col("device_id"), C.BUCKETS))
    return Y.read_together(spark, [f"{root}/{part}" for part in ("plain", "status", "bucket")])


@query
def bucket_counts(spark, d):
    return Y.bucket_counts(S.telemetry(spark, d), "device_id")


@query
def partition_preserves_rows(spark, d):
    return Y.narrowed(Y.spread_out(S.ratings(spark, d), 8), 4)


@query
def partition_rows(spark, d):
    """Rows over all partitions of a repartitioned table."""
    profile = Y.partition_profile(Y.spread_out(S.ratings(spark, d), 4))
    return profile.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))


@query
def compacted(spark, d):
    """A table of many small files rewritten; its rows stay the same."""
    small, merged = scratch_path(spark, "small"), scratch_path(spark, "compact")
    Y.spread_out(S.telemetry(spark, d), 16).write.parquet(small)
    Y.compact(spark, small, merged, [], ["device_id", "ts"])
    return spark.read.parquet(merged)


@query
def compacted_by_size(spark, d):
    """Only the folder with small files is written anew; rows, files and what was rewritten by folder."""
    path, rows = scratch_path(spark, "sized"), S.telemetry(spark, d)
    Y.spread_out(rows.where("status = 'OK'"), 16).write.partitionBy("status").parquet(path)
    rows.where("status = 'ERROR'").coalesce(1).write.mode("append").partitionBy("status").parquet(path)
    done = Y.compact_small(spark, path, rows.schema, ["status"], ["device_id", "ts"])
    files = Y.file_sizes(spark, path, rows.schema, ["status"]).groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    return files.join(done.select("status", F.lit(True).alias("rewritten")), "status", "left").fillna(False, ["rewritten"])


@query
def sales_with_stock_bucketed(spark, d):
    """The join of two tables bucketed by its keys; neither side is shuffled again."""
    run = scratch_path(spark, "bucketed")[-32:]
    sales = O.write_bucketed(spark, _sales(spark, d), f"sales_{run}", KEYS)
    stock = O.write_bucketed(spark, _stock(spark, d), f"stock_{run}", KEYS)
    return _money(U.sales_with_stock(sales, stock), "total_revenue")


@query
def retain_recent(spark, d):
    recent = Y.retain_recent(_dated(spark, d), F.lit("2024-01-30"), 7)
    return recent.withColumn("date", F.col("date").cast("string"))


# -- windows -------------------------------------------------------------------------


@query
def tumbling_hour(spark, d):
    return _settled(W.tumbling(S.telemetry(spark, d), "1 hour"), "avg_temperature")


@query
def tumbling_minute(spark, d):
    return _settled(W.tumbling(S.telemetry(spark, d)), "avg_temperature")


@query
def sliding_hour(spark, d):
    return _settled(W.sliding(S.telemetry(spark, d), "1 hour", "30 minutes"), "avg_temperature")


@query
def session_30m(spark, d):
    return _settled(_local(W.sessions(S.telemetry(spark, d), 1800), "window_start", "window_end"), "avg_temperature")


@query
def device_windows(spark, d):
    return W.device_windows(S.telemetry(spark, d), "1 hour")


# -- streams -------------------------------------------------------------------------


BACKLOG_FILES = 64  # of a topic, taken in at once


def _topic(spark, messages: DataFrame, label: str) -> str:
    """Messages in a topic folder, for replaying them as a stream."""
    path = scratch_path(spark, label)
    full = messages.select(
        "value",
        F.lit(None).cast("map<string,string>").alias("attributes"),
        F.lit("2026-06-10").cast("timestamp").alias("publish_time"),
    )
    full.write.option("compression", "zstd").parquet(path)
    return path


def _replayed(spark, d) -> DataFrame:
    """Readings as a stream of ordered micro-batches, one file each."""
    dealt, path = scratch_path(spark, "dealt"), scratch_path(spark, "arrivals")
    rows = S.replayed(spark, d)
    rows.repartition("batch").write.partitionBy("batch").parquet(dealt)
    for batch in range(S.REPLAY_BATCHES):
        spark.read.schema(rows.schema).parquet(dealt).where(F.col("batch") == batch).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _readings(spark, d) -> DataFrame:
    topic = _topic(spark, S.telemetry_messages(spark, d), "topic")
    return V.valid(V.tag_readings(R.read_messages(spark, topic)))


@query
def readings(spark, d):
    rows = V.valid(V.tag_readings(S.telemetry_messages(spark, d)))
    return _utc(rows, "ts")


@query
def stream_filter_ok(spark, d):
    """Replayed messages, filtered and appended to a table."""
    topic = _topic(spark, S.telemetry_messages(spark, d), "topic")
    path = scratch_path(spark, "ok")
    rows = V.valid(V.tag_telemetry(R.read_messages(spark, topic)))
    ingest.drained(ingest.append_stream(rows, path, f"{path}-checkpoint", once=True))
    return spark.read.parquet(path)


@query
def stream_dead_letters(spark, d):
    """Both outputs of a split stream, counted."""
    topic = _topic(spark, S.order_messages(spark, d), "topic")
    root = scratch_path(spark, "split")
    ingest.drained(ingest.ingest_retail(spark, {"orders": R.read_messages(spark, topic, BACKLOG_FILES)}, root, once=True))
    passed = spark.read.parquet(f"{root}/raw/orders").select(F.lit("VALID").alias("outcome"))
    failed = spark.read.parquet(f"{root}/rejected/orders").select(F.col("reason").alias("outcome"))
    return passed.unionByName(failed).groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


@query
def stream_three_sources(spark, d):
    """Orders, inventory and customers ingested side by side."""
    sources = {
        "orders": S.order_messages(spark, d),
        "inventory": S.inventory_messages(spark, d),
        "customers": S.customer_messages(spark, d),
    }
    streams = {k: R.read_messages(spark, _topic(spark, m, k), BACKLOG_FILES) for k, m in sources.items()}
    root = scratch_path(spark, "retail")
    ingest.drained(ingest.ingest_retail(spark, streams, root, once=True))
    tables = [
        spark.read.parquet(f"{root}/raw/{kind}").select(F.lit(kind).alias("kind")) for kind in sources
    ]
    every = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


def _checked(spark, d, again: bool) -> str:
    """Orders taken in with all checks, in four batches by time of arrival. Third lines arrive three days late;
    with ``again`` even stores' messages are delivered once more with the next batch."""
    messages = S.order_messages(spark, d, ("order_id", "store_id", "event_time"))
    order, when = F.col("order_id"), F.col("event_time")
    first = F.lit("1992-01-01").cast("timestamp")
    days = F.when(order.endswith("-3"), F.lit(3)).otherwise(F.lit(0))
    published = F.coalesce(F.try_to_timestamp(when), first) + F.make_interval(days=days)
    batch = F.least(F.greatest((F.year(published) - 1992) / 2, F.lit(0)), F.lit(3)).cast("int")
    batches = F.array(batch)
    if again:
        store = F.col("store_id").cast("long")
        batches = F.when(store % 2 == 0, F.array(batch, F.least(batch + 1, F.lit(3)))).otherwise(batches)
    sent = messages.select(
        "value", F.lit(None).cast("map<string,string>").alias("attributes"), published.alias("publish_time"), F.explode(batches).alias("batch")
    )
    dealt, topic, root = (scratch_path(spark, n) for n in ("dealt", "topic", "checked"))
    sent.write.partitionBy("batch").option("compression", "zstd").parquet(dealt)
    # order ids of these tables are not unique, so an event is told by all its fields
    kinds = {"orders": replace(checked.KINDS["orders"], ids=V.ORDER_RULES.order)}
    arrivals = spark.read.schema(f"{R.MESSAGE_SCHEMA}, batch int").parquet(dealt)
    for number in range(4):  # a batch is as many files as there are tasks, so it is taken in before the next one arrives
        arrivals.where(F.col("batch") == number).drop("batch").write.mode("append").option("compression", "zstd").parquet(topic)
        ingest.drained(checked.ingest_checked({"orders": R.read_messages(spark, topic)}, root, kinds=kinds, once=True))
    return root


@query
def stream_checked_orders(spark, d):
    """Orders that keep the contract, without repeats, with late ones tagged."""
    return spark.read.parquet(f"{_checked(spark, d, again=True)}/raw/orders").select("order_id", "store_id", "is_late")


@query
def stream_checked_rejects(spark, d):
    """Orders that were not taken in, by reason."""
    rejected = spark.read.parquet(f"{_checked(spark, d, again=False)}/rejected/orders")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def stream_closed_windows(spark, d):
    """Windows that the watermark has closed after the replay."""
    path = scratch_path(spark, "windows")
    closed = state.closed_windows(_readings(spark, d), "1 hour")
    ingest.drained(ingest.append_stream(closed, path, f"{path}-checkpoint", once=True))
    return _utc(spark.read.parquet(path), "window_start", "window_end")


@query
def stream_window_updates(spark, d):
    """The last value of every window in update mode, open ones included."""
    path = scratch_path(spark, "updates")
    ingest.drained(state.window_updates(_readings(spark, d), path, f"{path}-checkpoint", "1 hour", once=True))
    return _utc(state.newest_updates(spark, path), "window_start", "window_end")


@query
def stream_window_panes(spark, d):
    """Windows fired by the watermark and fired again by late rows; rows beyond the allowance are gone."""
    path = scratch_path(spark, "panes")
    ingest.drained(state.window_panes(_replayed(spark, d), path, f"{path}-checkpoint", once=True))
    panes = spark.read.parquet(path).withColumnRenamed("_batch", "batch").withColumn("batch", F.col("batch").cast("int"))
    return _utc(panes, "window_start", "window_end")


@query
def stream_resumed(spark, d):
    """A consumer stopped after half of the messages goes on where it was, and every message counts once."""
    rows = S.telemetry_messages(spark, d)
    half = F.crc32("value") % 2 == 0
    topic, path = _topic(spark, rows.where(half), "topic"), scratch_path(spark, "resumed")

    def drain():
        ok = V.valid(V.tag_telemetry(R.read_messages(spark, topic, files_per_batch=3)))
        ingest.drained(ingest.append_stream(ok, path, f"{path}-checkpoint", once=True))

    drain()
    more = _topic(spark, rows.where(~half), "more")
    spark.read.parquet(more).write.mode("append").parquet(topic)
    drain()
    return spark.read.parquet(path)


@query
def stream_every_second(spark, d):
    """A stream that commits on a fixed cadence until all messages are there."""
    topic, path = _topic(spark, S.telemetry_messages(spark, d), "topic"), scratch_path(spark, "cadence")
    ok = V.valid(V.tag_telemetry(R.read_messages(spark, topic, files_per_batch=4)))
    running = ingest.append_stream(ok, path, f"{path}-checkpoint", every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(path)


@query
def stream_late_tags(spark, d):
    """Late rows of a stream in several batches, flagged as in one."""
    path = scratch_path(spark, "tags")
    arrival = ["arrival", "event_id"]
    ingest.drained(state.tag_late(_replayed(spark, d), path, f"{path}-checkpoint", "device_id", arrival, once=True))
    return spark.read.parquet(path).select("event_id", "device_id", "arrival", "is_late")


@query
def stream_sessions(spark, d):
    """Sessions that the watermark has closed after the replay."""
    path = scratch_path(spark, "sessions")
    timed = W.with_event_time(_readings(spark, d))
    ingest.drained(
        ingest.append_stream(W.sessions_streaming(timed, "30 minutes"), path, f"{path}-checkpoint", once=True)
    )
    return _settled(_utc(spark.read.parquet(path), "window_start", "window_end"), "avg_temperature")


@query
def stream_dedup(spark, d):
    """Ids of an order stream without their repeats."""
    topic = _topic(spark, S.order_messages(spark, d), "topic")
    orders = V.valid(V.tag_orders(R.read_messages(spark, topic)))
    timed = orders.select("order_id", F.try_to_timestamp("event_time").alias("ts"))
    path = scratch_path(spark, "dedup")
    kept = state.without_repeats(timed, ["order_id"], horizon="3650 days").select("order_id")
    ingest.drained(ingest.append_stream(kept, path, f"{path}-checkpoint", once=True))
    return spark.read.parquet(path)


@query
def stream_current_inventory(spark, d):
    """Current stock from the inventory stream."""
    topic = _topic(spark, S.inventory_messages(spark, d), "topic")
    events = V.valid(V.tag_inventory(R.dealt(R.read_messages(spark, topic, files_per_batch=2))))
    newest = [F.try_to_timestamp("event_time")]
    path = scratch_path(spark, "stock")
    ingest.drained(state.keep_current(events, KEYS, newest, path, f"{path}-checkpoint", once=True, width=2))
    return state.current_rows(spark, path, KEYS, newest, width=2)


@query
def stream_by_day(spark, d):
    """Readings landed in the folder of the day they were taken on."""
    path = scratch_path(spark, "days")
    day = _in_utc("ts").cast("date")
    ingest.drained(ingest.land_by_day(_readings(spark, d), path, f"{path}-checkpoint", day, once=True))
    landed = spark.read.parquet(path)
    return landed.groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("rows"))


@query
def written_days(spark, d):
    """Orders per written day."""
    return S.raw_orders(spark, d).groupBy(written_day(F.col("event_time")).alias("date")).agg(
        F.count("order_id").alias("orders")
    )


def _two_nights(spark, d):
    """The nightly run over the older events, then over the newer ones."""
    root = scratch_path(spark, "curated")
    prefix = f"night_{root[-32:]}_"
    inputs = (S.raw_orders(spark, d), S.raw_inventory(spark, d), S.raw_customers(spark, d))
    for night in (F.col("event_time") < CUT, F.col("event_time") >= CUT):
        done = run_curated(spark, *[rows.where(night) for rows in inputs], root, ["seq"], sales_by="month", prefix=prefix, stock_by="store_group")
    return done


@query
def curated_run(spark, d):
    """The product table after two nights."""
    return _money(_two_nights(spark, d).product_performance, "total_revenue")


@query
def curated_sales(spark, d):
    return _money(_two_nights(spark, d).sales_daily.drop("month"), "total_revenue")


@query
def curated_inventory(spark, d):
    return _two_nights(spark, d).inventory_by_store


@query
def curated_customers(spark, d):
    return _two_nights(spark, d).customer_360


@query
def curated_revenue(spark, d):
    return _money(_two_nights(spark, d).daily_store_revenue, "daily_revenue")

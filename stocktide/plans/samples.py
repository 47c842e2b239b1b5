"""Retail and telemetry inputs derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.sources.readers import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan(spark: SparkSession, sf_dir: str, name: str, spread_out: bool) -> DataFrame:
    """A table, on all cores where a query does much work per row."""
    rows = table(spark, sf_dir, name)
    return spread(rows) if spread_out else rows


def _midnight(ts: str) -> Column:
    return F.concat(F.col(ts).cast("date").cast("string"), F.lit("T00:00:00Z"))


def telemetry(spark: SparkSession, sf_dir: str, spread_out: bool = False, only: Column | None = None) -> DataFrame:
    """Sensor readings. ``only`` is a condition on the stored columns, so that it can be pushed to the files."""
    rows = scan(spark, sf_dir, "events", spread_out)
    return (rows if only is None else rows.where(only)).select(
        "event_id",
        F.col("user_id").cast("string").alias("device_id"),
        "ts",
        F.col("value").alias("temperature"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("double").alias("humidity"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("status"),
    )


def telemetry_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings in a bounded disorder of arrival."""
    moved = F.col("event_id") + (F.col("event_id") * 7919) % 200
    return telemetry(spark, sf_dir).withColumn("arrival", moved)


REPLAY_BATCHES = 6


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings two seconds apart, dealt to batches by arrival: most are up to 400 seconds
    out of order, one in fifty comes half the table late."""
    half = (table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0) // 2
    straggles = F.when(F.col("event_id") % 50 == 7, F.lit(half)).otherwise(F.lit(0))
    rows = telemetry_arrivals(spark, sf_dir).withColumns({
        "ts": F.timestamp_seconds(F.lit(1_704_067_200) + F.col("event_id") * 2),
        "arrival": F.col("arrival") + straggles,
    })
    last = rows.agg(F.max("arrival")).first()[0] or 0
    return rows.withColumn("batch", F.expr(f"cast(arrival * {REPLAY_BATCHES} div {last + 1} as int)"))


def raw_orders(spark: SparkSession, sf_dir: str, spread_out: bool = False, customers: bool = True) -> DataFrame:
    """Order lines; the customer needs a join, which ``customers=False`` leaves out."""
    items = scan(spark, sf_dir, "lineitem", spread_out)
    status = (
        F.when(F.col("l_returnflag") == "N", "COMPLETED")
        .when(F.col("l_returnflag") == "R", "RETURNED")
        .otherwise("CANCELLED")
    )
    customer = []
    if customers:
        heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        items = items.join(heads, items["l_orderkey"] == heads["o_orderkey"])
        customer = [F.col("o_custkey").cast("string").alias("customer_id")]
    return items.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        *customer,
        _midnight("l_shipdate").alias("event_time"),
        status.alias("status"),
    )


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "lineitem", spread_out=True).select(
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        (F.col("l_quantity").cast("int") - 1).alias("quantity_on_hand"),
        _midnight("l_shipdate").alias("event_time"),
        F.concat(F.lit("SUPPLIER_"), (F.col("l_suppkey") % 5 + 1).cast("string")).alias("supplier_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def raw_customers(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    heads = scan(spark, sf_dir, "orders", spread_out)
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    first = F.substring("o_orderpriority", 1, 1)
    tier = (
        F.when(first == "1", "PLATINUM").when(first == "2", "GOLD").when(first == "3", "SILVER").otherwise("BRONZE")
    )
    return heads.join(people, heads["o_custkey"] == people["c_custkey"]).select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("").alias("phone"),
        tier.alias("loyalty_tier"),
        _midnight("o_orderdate").alias("event_time"),
        F.col("o_orderkey").alias("seq"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movieId"),
        F.col("p_name").alias("title"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("|")).alias("genres"),
        (F.lit(1970) + F.col("p_size")).alias("year"),
        F.col("p_retailprice").alias("rating"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("userId"), F.col("l_partkey").alias("movieId"), F.col("l_quantity").alias("rating")
    )


def inventory_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log: one version per year, an empty shelf deletes its row, and changes of one
    key within a version are ordered by day and then by sequence number."""
    rows = raw_inventory(spark, sf_dir)
    day = F.datediff(F.substring("event_time", 1, 10).cast("date"), F.lit("1970-01-01").cast("date"))
    return rows.select(
        "store_id", "product_id", "quantity_on_hand", "supplier_id", "event_time",
        (F.substring("event_time", 1, 4).cast("bigint") - 1991).alias("_version"),
        F.when(F.col("quantity_on_hand") == 0, "delete").otherwise("upsert").alias("_op"),
        (day.cast("bigint") * 10_000_000_000_000 + F.col("seq")).alias("_seq"),
    )


# -- messages ------------------------------------------------------------------


def _pair(name: str, value: Column, text: bool = True) -> Column:
    quote = '"' if text else ""
    return F.concat(F.lit(f'"{name}":{quote}'), value.cast("string"), F.lit(quote))


def _document(*pairs: Column) -> Column:
    """JSON text of the pairs that are not null."""
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def order_messages(spark: SparkSession, sf_dir: str, beside: tuple[str, ...] = ()) -> DataFrame:
    """Orders as producers really send them: some quantities stand for a kind of defect. Columns ``beside`` the message
    are what it says, null where it is cut off; an empty time is null too."""
    q = F.col("quantity")
    text = q.cast("string")
    quantity = (
        F.when(q == 2, F.concat(F.lit('"quantity":"'), text, F.lit('"')))
        .when(q == 3, F.lit('"quantity":3.7'))
        .when(q == 4, F.lit('"quantity":"4.7"'))
        .when(q == 5, F.lit('"quantity":0'))
        .when(q == 10, F.lit('"quantity":true'))
        .otherwise(F.concat(F.lit('"quantity":'), text))
    )
    price = (
        F.when(q == 1, F.lit('"price":null')).when(q == 11, F.lit('"price":-5')).otherwise(_pair("price", F.col("price"), False))
    )
    customer = F.when(q == 8, F.lit('"customer_id":null')).when(q != 7, _pair("customer_id", F.col("customer_id")))
    moment = F.when(q == 9, F.lit('"event_time":""')).otherwise(_pair("event_time", F.col("event_time")))
    status = F.when(q == 12, F.lit('"status":"LOST"')).when(q != 7, _pair("status", F.col("status")))
    document = _document(
        _pair("order_id", F.col("order_id")), _pair("store_id", F.col("store_id")),
        _pair("product_id", F.col("product_id")), quantity, price, customer, moment, status,
    )
    cut = F.when(q == 6, F.concat(F.lit("{"), _pair("order_id", F.col("order_id")))).otherwise(document)
    said = {name: F.when(q == 6, None).otherwise(F.when(q == 9, None).otherwise(F.col(name)) if name == "event_time" else F.col(name)) for name in beside}
    return raw_orders(spark, sf_dir, spread_out=True).select(cut.cast("binary").alias("value"), *[c.alias(name) for name, c in said.items()])


def inventory_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quantity_on_hand")
    supplier = F.when(q != 1, _pair("supplier_id", F.col("supplier_id")))
    restocked = F.when(q == 2, F.lit('"last_restocked":""')).when(q == 3, F.lit('"last_restocked":"1999-01-01T00:00:00Z"'))
    store = F.when(q != 4, _pair("store_id", F.col("store_id")))
    document = _document(
        store, _pair("product_id", F.col("product_id")), _pair("quantity_on_hand", q, False),
        restocked, supplier, _pair("event_time", F.col("event_time")),
    )
    broken = F.when(q == 5, F.concat(F.lit("["), document, F.lit("]"))).otherwise(document)
    return raw_inventory(spark, sf_dir).select(broken.cast("binary").alias("value"))


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier, last = F.col("loyalty_tier"), F.col("last_name")
    email = (
        F.when(last == "BUILDING", F.lit('"email":"nowhere"'))
        .when((last == "MACHINERY") & (tier == "GOLD"), F.lit('"email":null'))
        .otherwise(_pair("email", F.col("email")))
    )
    level = F.when(tier != "BRONZE", _pair("loyalty_tier", tier))
    signup = F.when(tier == "SILVER", F.lit('"signup_date":"2020-02-30"')).when(tier == "GOLD", F.lit('"signup_date":"2020-02-28"'))
    document = _document(
        _pair("customer_id", F.col("customer_id")), _pair("first_name", F.col("first_name")),
        _pair("last_name", last), email, level, signup, _pair("event_time", F.col("event_time")),
    )
    return raw_customers(spark, sf_dir, spread_out=True).select(document.cast("binary").alias("value"))


def utc_text(ts: str) -> Column:
    """Microsecond UTC text of a time."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def telemetry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor messages; some humidities stand for a kind of defect."""
    h = F.col("humidity")
    temperature = (
        F.when(h == 1, F.lit('"temperature":null'))
        .when(h == 2, F.concat(F.lit('"temperature":"'), F.col("temperature").cast("string"), F.lit('"')))
        .when(h == 3, F.lit('"temperature":"hot"'))
        .when(h != 4, _pair("temperature", F.col("temperature"), False))
    )
    humidity = F.when(h != 5, _pair("humidity", h, False))
    status = F.when(h == 6, F.lit('"status":null')).otherwise(_pair("status", F.col("status")))
    device = F.when(h == 7, F.lit('"device_id":""')).otherwise(_pair("device_id", F.col("device_id")))
    stamp = F.when(h == 8, F.lit('"timestamp":"soon"')).when(h != 9, _pair("timestamp", utc_text("ts")))
    document = _document(device, temperature, humidity, status, stamp)
    cut = F.when(h == 10, F.substring(document, 1, 20)).otherwise(document)
    return telemetry(spark, sf_dir, spread_out=True).select(cut.cast("binary").alias("value"))

"""Decoding and validating event messages. stream-safe, no Python per row.

Each ``tag_*`` function returns one DataFrame with the decoded row in ``row`` and the
reason for rejecting it in ``reason`` (null for valid rows); ``valid`` and ``rejected``
split it, so valid plus rejected is always the input.

``compat=True`` writes the word ``None`` for an explicit null where a naive consumer
would; the default treats null like an absent field.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide import contracts as C
from stocktide.functions.numeric import finite
from stocktide.functions.payload import Field, is_object, with_fields
from stocktide.operators.contract_check import breaks_rules, broken_rules, needs

MALFORMED = "MALFORMED"
MISSING = "MISSING_REQUIRED"
UNUSABLE = "UNUSABLE_VALUE"
NOT_WANTED = "STATUS_NOT_OK"
BROKEN = "CONTRACT_BROKEN"


@dataclass(frozen=True)
class Rules:
    """Required fields, and how each output column is read from the payload."""

    required: tuple[str, ...]
    text: tuple[str, ...] = ()
    whole: tuple[str, ...] = ()
    number: tuple[str, ...] = ()
    defaults: tuple[tuple[str, str], ...] = ()
    fallback: tuple[tuple[str, str], ...] = ()
    order: tuple[str, ...] = ()


ORDER_RULES = Rules(
    required=("order_id", "store_id", "product_id", "quantity", "price", "event_time"),
    text=("order_id", "store_id", "product_id", "event_time"),
    whole=("quantity",),
    number=("price",),
    defaults=(("customer_id", C.DEFAULT_CUSTOMER), ("status", C.DEFAULT_ORDER_STATUS)),
    order=("order_id", "store_id", "product_id", "quantity", "price", "customer_id", "event_time", "status"),
)
INVENTORY_RULES = Rules(
    required=("store_id", "product_id", "quantity_on_hand", "event_time"),
    text=("store_id", "product_id", "event_time"),
    whole=("quantity_on_hand",),
    defaults=(("supplier_id", C.DEFAULT_SUPPLIER),),
    fallback=(("last_restocked", "event_time"),),
    order=("store_id", "product_id", "quantity_on_hand", "last_restocked", "supplier_id", "event_time"),
)
CUSTOMER_RULES = Rules(
    required=("customer_id", "email", "event_time"),
    text=("customer_id", "email", "event_time"),
    defaults=(
        ("first_name", ""),
        ("last_name", ""),
        ("phone", ""),
        ("loyalty_tier", C.DEFAULT_TIER),
        ("signup_date", ""),
    ),
    order=(
        "customer_id", "first_name", "last_name", "email", "phone", "loyalty_tier", "signup_date", "event_time",
    ),
)


def _tagged(df: DataFrame, value: str, names, asked: dict, columns: list[Column], reason: Column, *others: Column) -> DataFrame:
    """Add ``row``, ``reason`` and ``others`` to the input columns; ``asked`` is what they need of which fields."""
    return with_fields(df, value, names, **asked).select(
        *df.columns, F.struct(*columns).alias("row"), reason.alias("reason"), *others
    )


def tag(
    df: DataFrame, rules: Rules, value: str = "value", compat: bool = False, keep_zero: bool = False, contract: dict | None = None,
) -> DataFrame:
    """Apply rules. ``keep_zero`` counts a numeric zero as given (a truthiness test drops it). With a ``contract``
    over the same fields, its broken rules are listed in ``violations`` from the same parse, and a row that is
    valid otherwise is rejected for them."""
    fields = {name: Field(name) for name in rules.order}
    out: dict[str, Column] = {}
    for name in rules.text:
        out[name] = fields[name].as_text()
    for name in rules.whole:
        out[name] = fields[name].as_long()
    for name in rules.number:
        out[name] = fields[name].as_double()
    for name, default in rules.defaults:
        out[name] = fields[name].text_or(default, literal_null=compat)
    for name, other in rules.fallback:
        out[name] = F.when(fields[name].truthy(), fields[name].as_text()).otherwise(out[other])

    def given(name: str) -> Column:
        field = fields[name]
        if keep_zero and name in (*rules.whole, *rules.number):
            return field.truthy() | F.coalesce(field.is_number, F.lit(False))
        return field.truthy()

    complete = F.lit(True)
    for name in rules.required:
        complete = complete & given(name)
    readable = F.lit(True)
    for name in rules.order:
        readable = readable & out[name].isNotNull()
    reason = (
        F.when(~is_object(), MALFORMED).when(~complete, MISSING).when(~readable, UNUSABLE)
    )
    others = []
    asked = {
        "longs": rules.whole, "doubles": rules.number, "texts": rules.number, "numeric": (*rules.whole, *rules.number) if keep_zero else (),
        "strings": (*rules.text, *dict(rules.defaults), *dict(rules.fallback)), "truthy": (*rules.required, *dict(rules.fallback)),
    }
    if contract is not None:
        reason = F.coalesce(reason, F.when(breaks_rules(contract), BROKEN))
        others = [broken_rules(contract).alias("violations")]
        for need, fields_of in needs(contract).items():
            asked[need] = [*dict.fromkeys((*asked[need], *fields_of))]
    row = [out[name].alias(name) for name in rules.order]
    return _tagged(df, value, rules.order, asked, row, reason, *others)


def tag_orders(df: DataFrame, **options) -> DataFrame:
    return tag(df, ORDER_RULES, **options)


def tag_inventory(df: DataFrame, **options) -> DataFrame:
    return tag(df, INVENTORY_RULES, **options)


def tag_customers(df: DataFrame, **options) -> DataFrame:
    return tag(df, CUSTOMER_RULES, **options)


SENSOR_FIELDS = ("device_id", "temperature", "humidity", "status", "timestamp")
SENSOR_NUMBERS = ("temperature", "humidity")


def tag_telemetry(df: DataFrame, value: str = "value", compat: bool = False) -> DataFrame:
    """Sensor messages: device and status are needed, only status OK is wanted, both
    readings have to be finite numbers."""
    device, status = Field("device_id"), Field("status")
    temperature, humidity = Field("temperature"), Field("humidity")
    warmth, moisture = finite(temperature.as_double()), finite(humidity.as_double())
    stamp = Field("timestamp")
    when = stamp.as_text()
    if compat:
        when = F.coalesce(when, F.when(stamp.missing, F.lit("None")))
    columns = [
        device.as_text().alias("device_id"),
        warmth.alias("temperature"),
        moisture.alias("humidity"),
        status.as_text().alias("status"),
        when.alias("timestamp"),
    ]
    wanted = F.coalesce(status.is_text & (status.text == C.OK_STATUS), F.lit(False))
    reason = (
        F.when(~is_object(), MALFORMED)
        .when(~device.truthy() | status.missing, MISSING)
        .when(~wanted, NOT_WANTED)
        .when(warmth.isNull() | moisture.isNull(), UNUSABLE)
    )
    asked = {"longs": (), "doubles": SENSOR_NUMBERS, "texts": (*SENSOR_NUMBERS, "status"), "numeric": (), "strings": ("device_id", "status", "timestamp")}
    return _tagged(df, value, SENSOR_FIELDS, {**asked, "truthy": ("device_id",)}, columns, reason)


def tag_readings(df: DataFrame, value: str = "value") -> DataFrame:
    """Sensor messages for windows: device and a readable time are needed; readings that
    are missing stay null, readings that are not finite numbers
    reject the message."""
    device, status, stamp = Field("device_id"), Field("status"), Field("timestamp")
    temperature, humidity = Field("temperature"), Field("humidity")
    warmth, moisture = finite(temperature.as_double()), finite(humidity.as_double())
    ts = F.when(stamp.is_text, F.try_to_timestamp(stamp.text))
    columns = [
        device.as_text().alias("device_id"),
        ts.alias("ts"),
        warmth.alias("temperature"),
        moisture.alias("humidity"),
        status.as_text().alias("status"),
    ]
    spoiled = (~temperature.absent & warmth.isNull()) | (~humidity.absent & moisture.isNull())
    reason = (
        F.when(~is_object(), MALFORMED)
        .when(~device.truthy() | ~stamp.truthy(), MISSING)
        .when(ts.isNull() | device.as_text().isNull() | spoiled, UNUSABLE)
    )
    asked = {"longs": (), "doubles": SENSOR_NUMBERS, "texts": (*SENSOR_NUMBERS, "timestamp"), "numeric": (), "strings": ("device_id", "status")}
    return _tagged(df, value, SENSOR_FIELDS, {**asked, "truthy": ("device_id", "timestamp")}, columns, reason)


def valid(tagged: DataFrame) -> DataFrame:
    """The typed rows that passed."""
    return tagged.where(F.col("reason").isNull()).select("row.*")


def rejected(tagged: DataFrame) -> DataFrame:
    """The untouched messages that did not pass, with the reason."""
    return tagged.where(F.col("reason").isNotNull()).drop("row")


def outcome_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy(F.coalesce("reason", F.lit("VALID")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def read_field(df: DataFrame, column: str, name: str, kind: str) -> DataFrame:
    """One typed field of a JSON text column; null when absent or of another kind."""
    return df.withColumn(name, F.try_variant_get(F.try_parse_json(column), f"$.{name}", kind))

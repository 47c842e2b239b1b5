"""SQL counterparts of the catalogue, written for DuckDB over the same tables.

They share no code with the operators: means come from integer cents,
JSON is taken apart with the JSON functions, sessions come from gaps, and states from row
numbers over the whole log.
"""

from __future__ import annotations

TELEMETRY = """telemetry AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS device_id, ts, value AS temperature,
         TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS humidity,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status
  FROM events)"""

ORDERS = """raw_orders AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         CAST(l_suppkey AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INT) AS quantity, l_extendedprice AS price,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'T00:00:00Z' AS event_time,
         CASE l_returnflag WHEN 'N' THEN 'COMPLETED' WHEN 'R' THEN 'RETURNED' ELSE 'CANCELLED' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

INVENTORY = """raw_inventory AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(CAST(l_quantity AS INT) - 1 AS INT) AS quantity_on_hand,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'T00:00:00Z' AS event_time,
         'SUPPLIER_' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS supplier_id,
         l_orderkey * 10 + l_linenumber AS seq
  FROM lineitem)"""

CUSTOMERS = """raw_customers AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
         'c' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email, '' AS phone,
         CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'PLATINUM' WHEN '2' THEN 'GOLD'
              WHEN '3' THEN 'SILVER' ELSE 'BRONZE' END AS loyalty_tier,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T00:00:00Z' AS event_time, o_orderkey AS seq
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

MOVIES = """movies AS (
  SELECT p_partkey AS "movieId", p_name AS title, replace(p_name, ' ', '|') AS genres,
         CAST(1970 + p_size AS INT) AS year, p_retailprice AS rating
  FROM part)"""

RATINGS = """ratings AS (
  SELECT l_suppkey AS "userId", l_partkey AS "movieId", l_quantity AS rating FROM lineitem)"""

SALES = ORDERS + """, sales AS (
  SELECT substring(event_time, 1, 10) AS date, store_id, product_id,
         CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         CAST(SUM(CAST(quantity AS DECIMAL(10,0)) * CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         COUNT(order_id) AS order_count
  FROM raw_orders WHERE status = 'COMPLETED' GROUP BY 1, 2, 3)"""

CHANGES = INVENTORY + """, changes AS (
  SELECT store_id, product_id, quantity_on_hand, supplier_id, event_time,
         CAST(substring(event_time, 1, 4) AS BIGINT) - 1991 AS version,
         CASE WHEN quantity_on_hand = 0 THEN 'delete' ELSE 'upsert' END AS op, seq
  FROM raw_inventory)"""


def rounded_mean(column: str, parts: int) -> str:
    """Mean in whole ``parts`` of one (100: hundredths), rounded half up, for values from zero up and in cents."""
    total = f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) * 100 AS HUGEINT) * {parts // 100}"
    return f"((2 * {total} + COUNT({column})) // (2 * COUNT({column})))"


def mean(column: str) -> str:
    """In six places."""
    return f"CAST({rounded_mean(column, 1_000_000)} AS DOUBLE) / 1000000"


def cents(column: str) -> str:
    return rounded_mean(column, 100)


def mean_2dp(column: str) -> str:
    return f"CAST({cents(column)} AS DOUBLE) / 100"


def latest(source: str, keys: str, order: str, columns: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source}) WHERE rn = 1"
    )


STOCK_ORDER = "event_time DESC, seq DESC, quantity_on_hand DESC, supplier_id DESC"
STOCK_COLUMNS = "store_id, product_id, quantity_on_hand, event_time, supplier_id, seq"
PEOPLE_ORDER = "event_time DESC, seq DESC, first_name DESC, last_name DESC, email DESC, loyalty_tier DESC"
PEOPLE_COLUMNS = "customer_id, first_name, last_name, email, phone, loyalty_tier, event_time, seq"


def stock(source: str = "raw_inventory", where: str = "true") -> str:
    return latest(f"(SELECT * FROM {source} WHERE {where})", "store_id, product_id", STOCK_ORDER, STOCK_COLUMNS)


def people(where: str = "true") -> str:
    return latest(f"(SELECT * FROM raw_customers WHERE {where})", "customer_id", PEOPLE_ORDER, PEOPLE_COLUMNS)


def state(where: str) -> str:
    """State of the change log: last change per key, tombstones dropped."""
    order = "version DESC, event_time DESC, seq DESC, quantity_on_hand DESC, supplier_id DESC"
    return (
        "SELECT store_id, product_id, quantity_on_hand, supplier_id, event_time FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY {order}) AS rn "
        f"FROM changes WHERE {where}) WHERE rn = 1 AND op <> 'delete'"
    )


# -- messages --------------------------------------------------------------------


def text(name: str, value: str) -> str:
    return f"""'"{name}":"' || {value} || '"'"""


def bare(name: str, value: str) -> str:
    return f"""'"{name}":' || CAST({value} AS VARCHAR)"""


def document(*pairs: str) -> str:
    return "'{' || concat_ws(',', " + ", ".join(pairs) + ") || '}'"


ORDER_DOCUMENT = document(
    text("order_id", "order_id"), text("store_id", "store_id"), text("product_id", "product_id"),
    f"""CASE quantity WHEN 2 THEN '"quantity":"2"' WHEN 3 THEN '"quantity":3.7' WHEN 4 THEN '"quantity":"4.7"'
        WHEN 5 THEN '"quantity":0' WHEN 10 THEN '"quantity":true' ELSE {bare('quantity', 'quantity')} END""",
    f"""CASE quantity WHEN 1 THEN '"price":null' WHEN 11 THEN '"price":-5' ELSE {bare('price', 'price')} END""",
    f"""CASE quantity WHEN 8 THEN '"customer_id":null' WHEN 7 THEN NULL ELSE {text('customer_id', 'customer_id')} END""",
    f"""CASE quantity WHEN 9 THEN '"event_time":""' ELSE {text('event_time', 'event_time')} END""",
    f"""CASE quantity WHEN 12 THEN '"status":"LOST"' WHEN 7 THEN NULL ELSE {text('status', 'status')} END""",
)
ORDER_CUT = "'{' || " + text("order_id", "order_id")
ORDER_MESSAGES = ORDERS + f""", messages AS (
  SELECT CASE WHEN quantity = 6 THEN {ORDER_CUT} ELSE {ORDER_DOCUMENT} END AS value FROM raw_orders)"""

INVENTORY_DOCUMENT = document(
    f"CASE WHEN quantity_on_hand <> 4 THEN {text('store_id', 'store_id')} END",
    text("product_id", "product_id"), bare("quantity_on_hand", "quantity_on_hand"),
    """CASE quantity_on_hand WHEN 2 THEN '"last_restocked":""'
       WHEN 3 THEN '"last_restocked":"1999-01-01T00:00:00Z"' END""",
    f"CASE WHEN quantity_on_hand <> 1 THEN {text('supplier_id', 'supplier_id')} END",
    text("event_time", "event_time"),
)
INVENTORY_MESSAGES = INVENTORY + f""", messages AS (
  SELECT CASE WHEN quantity_on_hand = 5 THEN '[' || {INVENTORY_DOCUMENT} || ']' ELSE {INVENTORY_DOCUMENT} END AS value
  FROM raw_inventory)"""

CUSTOMER_DOCUMENT = document(
    text("customer_id", "customer_id"), text("first_name", "first_name"), text("last_name", "last_name"),
    f"""CASE WHEN last_name = 'BUILDING' THEN '"email":"nowhere"'
        WHEN last_name = 'MACHINERY' AND loyalty_tier = 'GOLD' THEN '"email":null'
        ELSE {text('email', 'email')} END""",
    f"CASE WHEN loyalty_tier <> 'BRONZE' THEN {text('loyalty_tier', 'loyalty_tier')} END",
    """CASE loyalty_tier WHEN 'SILVER' THEN '"signup_date":"2020-02-30"'
       WHEN 'GOLD' THEN '"signup_date":"2020-02-28"' END""",
    text("event_time", "event_time"),
)
CUSTOMER_MESSAGES = CUSTOMERS + f""", messages AS (SELECT {CUSTOMER_DOCUMENT} AS value FROM raw_customers)"""

STAMP = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
TELEMETRY_DOCUMENT = document(
    f"""CASE WHEN humidity = 7 THEN '"device_id":""' ELSE {text('device_id', 'device_id')} END""",
    f"""CASE WHEN humidity = 1 THEN '"temperature":null'
        WHEN humidity = 2 THEN {text('temperature', 'CAST(temperature AS VARCHAR)')}
        WHEN humidity = 3 THEN '"temperature":"hot"'
        WHEN humidity <> 4 THEN {bare('temperature', 'temperature')} END""",
    f"CASE WHEN humidity <> 5 THEN {bare('humidity', 'humidity')} END",
    f"""CASE WHEN humidity = 6 THEN '"status":null' ELSE {text('status', 'status')} END""",
    f"""CASE WHEN humidity = 8 THEN '"timestamp":"soon"'
        WHEN humidity <> 9 THEN {text('timestamp', STAMP)} END""",
)
TELEMETRY_MESSAGES = TELEMETRY + f""", messages AS (
  SELECT CASE WHEN humidity = 10 THEN substring({TELEMETRY_DOCUMENT}, 1, 20) ELSE {TELEMETRY_DOCUMENT} END AS value
  FROM telemetry)"""

NUMBERS = "('BIGINT', 'UBIGINT', 'HUGEINT', 'UHUGEINT', 'DOUBLE')"
WHOLES = "('BIGINT', 'UBIGINT', 'HUGEINT', 'UHUGEINT')"


def fields(messages: str, *names: str) -> str:
    """CTE ``f`` with type ``<name>_t`` and text ``<name>_s`` of each field."""
    columns = ", ".join(
        f"json_type(doc, '$.{n}') AS {n}_t, json_extract_string(doc, '$.{n}') AS {n}_s" for n in names
    )
    return (
        f"WITH {messages}, d AS (SELECT value, CASE WHEN json_valid(value) THEN value END AS doc FROM messages), "
        f"f AS (SELECT value, COALESCE(json_type(doc), 'NONE') = 'OBJECT' AS is_object, {columns} FROM d) "
    )


def truthy(n: str) -> str:
    return (
        f"COALESCE(CASE WHEN {n}_t = 'VARCHAR' THEN {n}_s <> '' WHEN {n}_t = 'BOOLEAN' THEN {n}_s = 'true' "
        f"WHEN {n}_t IN {NUMBERS} THEN CAST({n}_s AS DOUBLE) <> 0 END, false)"
    )


def whole(n: str) -> str:
    return (
        f"CASE WHEN {n}_t = 'VARCHAR' THEN CASE WHEN regexp_matches({n}_s, '^[+-]?[0-9]+$') "
        f"THEN CAST({n}_s AS BIGINT) END WHEN {n}_t = 'BOOLEAN' THEN CAST({n}_s = 'true' AS BIGINT) "
        f"WHEN {n}_t IN {NUMBERS} THEN CAST(trunc(CAST({n}_s AS DOUBLE)) AS BIGINT) END"
    )


def number(n: str) -> str:
    return (
        f"CASE WHEN {n}_t = 'VARCHAR' THEN TRY_CAST({n}_s AS DOUBLE) WHEN {n}_t IN {NUMBERS} "
        f"THEN CAST({n}_s AS DOUBLE) WHEN {n}_t = 'BOOLEAN' THEN CAST(CAST({n}_s = 'true' AS INT) AS DOUBLE) END"
    )


def missing(n: str) -> str:
    return f"COALESCE({n}_t = 'NULL', true)"


def text_or(n: str, default: str, null: str | None = None) -> str:
    null = default if null is None else null
    return f"CASE WHEN {n}_t IS NULL THEN '{default}' WHEN {n}_t = 'NULL' THEN '{null}' ELSE {n}_s END"


ORDER_FIELDS = ("order_id", "store_id", "product_id", "quantity", "price", "customer_id", "event_time", "status")
ORDER_REQUIRED = " AND ".join(map(truthy, ("order_id", "store_id", "product_id", "quantity", "price", "event_time")))
ORDER_READABLE = f"{whole('quantity')} IS NOT NULL AND {number('price')} IS NOT NULL"


def orders_valid(null: str | None) -> str:
    customer_null = None if null is None else null
    return (
        fields(ORDER_MESSAGES, *ORDER_FIELDS)
        + f"""SELECT order_id_s AS order_id, store_id_s AS store_id, product_id_s AS product_id,
        {whole('quantity')} AS quantity, {number('price')} AS price,
        {text_or('customer_id', 'ANONYMOUS', customer_null)} AS customer_id, event_time_s AS event_time,
        {text_or('status', 'COMPLETED', null)} AS status
        FROM f WHERE is_object AND {ORDER_REQUIRED} AND {ORDER_READABLE}"""
    )


ORDER_OUTCOMES = (
    fields(ORDER_MESSAGES, *ORDER_FIELDS)
    + f"""SELECT CASE WHEN NOT is_object THEN 'MALFORMED' WHEN NOT ({ORDER_REQUIRED}) THEN 'MISSING_REQUIRED'
    WHEN NOT ({ORDER_READABLE}) THEN 'UNUSABLE_VALUE' ELSE 'VALID' END AS outcome, COUNT(*) AS messages
    FROM f GROUP BY 1"""
)

INVENTORY_FIELDS = ("store_id", "product_id", "quantity_on_hand", "last_restocked", "supplier_id", "event_time")


def inventory_select(keep_zero: bool) -> str:
    given = f"quantity_on_hand_t IN {NUMBERS}" if keep_zero else truthy("quantity_on_hand")
    return (
        f"""SELECT store_id_s AS store_id, product_id_s AS product_id, {whole('quantity_on_hand')} AS quantity_on_hand,
        CASE WHEN {truthy('last_restocked')} THEN last_restocked_s ELSE event_time_s END AS last_restocked,
        {text_or('supplier_id', 'UNKNOWN')} AS supplier_id, event_time_s AS event_time
        FROM f WHERE is_object AND {truthy('store_id')} AND {truthy('product_id')} AND {given} AND {truthy('event_time')}"""
    )


def inventory_valid(keep_zero: bool) -> str:
    return fields(INVENTORY_MESSAGES, *INVENTORY_FIELDS) + inventory_select(keep_zero)


CUSTOMER_FIELDS = (
    "customer_id", "first_name", "last_name", "email", "phone", "loyalty_tier", "signup_date", "event_time",
)
CUSTOMERS_VALID = (
    fields(CUSTOMER_MESSAGES, *CUSTOMER_FIELDS)
    + f"""SELECT customer_id_s AS customer_id, {text_or('first_name', '')} AS first_name,
    {text_or('last_name', '')} AS last_name, email_s AS email, {text_or('phone', '')} AS phone,
    {text_or('loyalty_tier', 'BRONZE')} AS loyalty_tier, {text_or('signup_date', '')} AS signup_date,
    event_time_s AS event_time
    FROM f WHERE is_object AND {truthy('customer_id')} AND {truthy('email')} AND {truthy('event_time')}"""
)

TELEMETRY_FIELDS = ("device_id", "temperature", "humidity", "status", "timestamp")
TELEMETRY_REASON = f"""CASE WHEN NOT is_object THEN 'MALFORMED'
    WHEN NOT {truthy('device_id')} OR {missing('status')} THEN 'MISSING_REQUIRED'
    WHEN status_s <> 'OK' THEN 'STATUS_NOT_OK'
    WHEN {number('temperature')} IS NULL OR {number('humidity')} IS NULL THEN 'UNUSABLE_VALUE' END"""
TELEMETRY_OK = (
    fields(TELEMETRY_MESSAGES, *TELEMETRY_FIELDS)
    + f"""SELECT device_id_s AS device_id, {number('temperature')} AS temperature, {number('humidity')} AS humidity,
    status_s AS status, timestamp_s AS timestamp FROM f WHERE {TELEMETRY_REASON} IS NULL"""
)
TELEMETRY_REJECTED = (
    fields(TELEMETRY_MESSAGES, *TELEMETRY_FIELDS)
    + f"SELECT value, {TELEMETRY_REASON} AS reason FROM f WHERE {TELEMETRY_REASON} IS NOT NULL"
)
READING_TIME = "TRY_CAST(replace(timestamp_s, 'Z', '') AS TIMESTAMP)"
READINGS = (
    fields(TELEMETRY_MESSAGES, *TELEMETRY_FIELDS)
    + f""", readings AS (SELECT device_id_s AS device_id, {READING_TIME} AS ts, {number('temperature')} AS temperature,
    {number('humidity')} AS humidity, status_s AS status
    FROM f WHERE is_object AND {truthy('device_id')} AND {truthy('timestamp')} AND {READING_TIME} IS NOT NULL
    AND NOT (temperature_t IS NOT NULL AND {number('temperature')} IS NULL)
    AND NOT (humidity_t IS NOT NULL AND {number('humidity')} IS NULL))"""
)


# -- contracts -------------------------------------------------------------------


def codes(rules: list[tuple[str, str]]) -> str:
    """Violation counts: a list of (code, condition of a violation)."""
    parts = [f"SELECT 'document:type' AS violation FROM f WHERE NOT is_object"]
    parts += [f"SELECT '{code}' FROM f WHERE is_object AND ({condition})" for code, condition in rules]
    return "SELECT violation, COUNT(*) AS messages FROM (" + " UNION ALL ".join(parts) + ") GROUP BY 1"


def required(n: str) -> tuple[str, str]:
    return f"{n}:required", f"{n}_t IS NULL"


def is_text(n: str) -> tuple[str, str]:
    return f"{n}:type", f"{n}_t IS NOT NULL AND {n}_t <> 'VARCHAR'"


def is_number(n: str) -> tuple[str, str]:
    return f"{n}:type", f"{n}_t IS NOT NULL AND {n}_t NOT IN {NUMBERS}"


def is_whole(n: str) -> tuple[str, str]:
    fraction = f"CASE WHEN {n}_t = 'DOUBLE' THEN CAST({n}_s AS DOUBLE) <> trunc(CAST({n}_s AS DOUBLE)) ELSE {n}_t NOT IN {WHOLES} END"
    return f"{n}:type", f"{n}_t IS NOT NULL AND {fraction}"


def at_least(n: str, low: str) -> tuple[str, str]:
    return f"{n}:minimum", f"CASE WHEN {n}_t IN {NUMBERS} THEN CAST({n}_s AS DOUBLE) < {low} ELSE false END"


def one_of(n: str, *values: str) -> tuple[str, str]:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"{n}:enum", f"{n}_t IS NOT NULL AND NOT COALESCE({n}_t = 'VARCHAR' AND {n}_s IN ({listed}), false)"


def moment(n: str) -> tuple[str, str]:
    return (
        f"{n}:format",
        f"{n}_t = 'VARCHAR' AND NOT regexp_matches({n}_s, "
        "'^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$')",
    )


ORDER_BREAKS = (
    [required(n) for n in ("order_id", "store_id", "product_id", "quantity", "price", "event_time")]
    + [is_text(n) for n in ("order_id", "store_id", "product_id", "customer_id", "event_time", "status")]
    + [
        is_whole("quantity"), at_least("quantity", "1"), is_number("price"), at_least("price", "0.01"),
        moment("event_time"), one_of("status", "COMPLETED", "RETURNED", "CANCELLED"),
    ]
)
ORDER_CODES = fields(ORDER_MESSAGES, *ORDER_FIELDS) + codes(ORDER_BREAKS)
ORDER_BROKEN = " OR ".join(f"({condition})" for _, condition in ORDER_BREAKS)
CHECKED_ORDERS = fields(ORDER_MESSAGES, *ORDER_FIELDS) + f""", timed AS (
    SELECT order_id_s AS order_id, store_id_s AS store_id, CAST(substring(event_time_s, 1, 10) AS TIMESTAMP) AS ts,
        CASE WHEN order_id_s LIKE '%-3' THEN 3 ELSE 0 END AS days, product_id_s, quantity_s, price_s, customer_id_s, status_s
    FROM f WHERE is_object AND {ORDER_REQUIRED} AND {ORDER_READABLE} AND NOT COALESCE({ORDER_BROKEN}, false)),
    seen AS (SELECT *, MAX(ts) OVER (PARTITION BY store_id ORDER BY ts + days * INTERVAL '1 day', order_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM (SELECT DISTINCT * FROM timed))
    SELECT order_id, store_id, COALESCE(ts < peak - INTERVAL '120 seconds', false) AS is_late FROM seen"""
CHECKED_REJECTS = fields(ORDER_MESSAGES, *ORDER_FIELDS) + f"""SELECT reason, COUNT(*) AS messages FROM (
    SELECT CASE WHEN NOT is_object THEN 'MALFORMED' WHEN NOT ({ORDER_REQUIRED}) THEN 'MISSING_REQUIRED'
    WHEN NOT ({ORDER_READABLE}) THEN 'UNUSABLE_VALUE' WHEN {ORDER_BROKEN} THEN 'CONTRACT_BROKEN' END AS reason FROM f)
    WHERE reason IS NOT NULL GROUP BY 1"""
INVENTORY_CODES = fields(INVENTORY_MESSAGES, *INVENTORY_FIELDS) + codes(
    [required(n) for n in ("store_id", "product_id", "quantity_on_hand", "event_time")]
    + [is_text(n) for n in ("store_id", "product_id", "last_restocked", "supplier_id", "event_time")]
    + [is_whole("quantity_on_hand"), at_least("quantity_on_hand", "0"), moment("last_restocked"), moment("event_time")]
)
CUSTOMER_CODES = fields(CUSTOMER_MESSAGES, *CUSTOMER_FIELDS) + codes(
    [required(n) for n in ("customer_id", "email", "loyalty_tier", "event_time")]
    + [is_text(n) for n in CUSTOMER_FIELDS]
    + [
        ("email:format", "email_t = 'VARCHAR' AND NOT regexp_matches(email_s, '^[^@ ]+@[^@ ]+[.][^@ ]+$')"),
        one_of("loyalty_tier", "BRONZE", "SILVER", "GOLD", "PLATINUM"),
        ("signup_date:format", "signup_date_t = 'VARCHAR' AND TRY_CAST(signup_date_s AS DATE) IS NULL"),
        moment("event_time"),
    ]
)


# -- windows ---------------------------------------------------------------------


def windows(source: str, width: str, having: str = "") -> str:
    """Device statistics per fixed window."""
    return f"""SELECT device_id, time_bucket(INTERVAL '{width}', ts) AS window_start,
        time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end,
        {mean_2dp('temperature')} AS avg_temperature,
        CASE WHEN COUNT(humidity) = 0 THEN 0.0 ELSE {mean_2dp('humidity')} END AS avg_humidity,
        COUNT(*) AS reading_count, COUNT(*) FILTER (WHERE status = 'ERROR') AS error_count
        FROM {source} GROUP BY 1, 2, 3 HAVING COUNT(temperature) > 0{having}"""


def tumbling(width: str) -> str:
    return f"""WITH {TELEMETRY} SELECT device_id, time_bucket(INTERVAL '{width}', ts) AS window_start,
        time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end,
        COUNT(*) AS reading_count, {mean('temperature')} AS avg_temperature
        FROM telemetry GROUP BY 1, 2, 3"""


def session_rows(source: str, gap: str) -> str:
    return f"""marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '{gap}' THEN 0 ELSE 1 END AS opens
          FROM {source} WINDOW w AS (PARTITION BY device_id ORDER BY ts)),
        runs AS (SELECT *, SUM(opens) OVER (PARTITION BY device_id ORDER BY ts
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM marked),
        sessions AS (SELECT device_id, MIN(ts) AS window_start, MAX(ts) + INTERVAL '{gap}' AS window_end,
          COUNT(*) AS reading_count, {mean('temperature')} AS avg_temperature
          FROM runs GROUP BY device_id, run)"""


CLOSED = " AND window_end <= (SELECT date_trunc('millisecond', MAX(ts)) FROM readings) - INTERVAL '120 seconds'"
SLIDES = f"""WITH {TELEMETRY}, slides AS (
    SELECT device_id, temperature, time_bucket(INTERVAL '30 minutes', ts) AS window_start FROM telemetry
    UNION ALL
    SELECT device_id, temperature, time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes' FROM telemetry)
    SELECT device_id, window_start, window_start + INTERVAL '1 hour' AS window_end, COUNT(*) AS reading_count,
    {mean('temperature')} AS avg_temperature FROM slides GROUP BY 1, 2, 3"""

REPLAYED = f"""{TELEMETRY}, moved AS (
    SELECT * EXCLUDE (ts), TIMESTAMP '2024-01-01' + to_seconds(2 * event_id) AS ts,
           event_id + (event_id * 7919) % 200
           + CASE WHEN event_id % 50 = 7 THEN (SELECT MAX(event_id) // 2 FROM events) ELSE 0 END AS arrival FROM telemetry),
    dealt AS (SELECT *, CAST(arrival * 6 // (SELECT MAX(arrival) + 1 FROM moved) AS INTEGER) AS batch FROM moved)"""

#: ``seen`` is the watermark a batch fires by (newest time before it). Spark drops rows by that of the batch before.
PANES = f"""WITH {REPLAYED},
    rows_ AS (SELECT *, time_bucket(INTERVAL '60 seconds', ts) AS window_start,
              time_bucket(INTERVAL '60 seconds', ts) + INTERVAL '60 seconds' AS window_end FROM dealt),
    peaks AS (SELECT batch, MAX(MAX(ts)) OVER (ORDER BY batch) AS newest FROM dealt GROUP BY batch),
    marks AS (SELECT batch, newest, lag(newest) OVER (ORDER BY batch) AS seen, lag(newest, 2) OVER (ORDER BY batch) AS drops FROM peaks),
    taken AS (SELECT r.* FROM rows_ r JOIN marks m ON m.batch = r.batch
              WHERE m.drops IS NULL OR r.window_end + INTERVAL '120 seconds' > m.drops),
    fired AS (SELECT w.*, m.batch, CASE WHEN m.seen IS NULL OR w.window_end > m.seen THEN 'ON_TIME' ELSE 'LATE' END AS pane
              FROM (SELECT DISTINCT device_id, window_start, window_end FROM taken) w JOIN marks m ON w.window_end <= m.newest)
    SELECT f.device_id, f.window_start, f.window_end, f.batch, f.pane, {mean_2dp('temperature')} AS avg_temperature,
           CASE WHEN COUNT(humidity) = 0 THEN 0.0 ELSE {mean_2dp('humidity')} END AS avg_humidity,
           COUNT(*) AS reading_count, COUNT(*) FILTER (WHERE status = 'ERROR') AS error_count
    FROM fired f JOIN taken t ON t.device_id = f.device_id AND t.window_start = f.window_start AND t.batch <= f.batch
    GROUP BY 1, 2, 3, 4, 5 HAVING COUNT(temperature) > 0 AND (f.pane = 'ON_TIME' OR COUNT(*) FILTER (WHERE t.batch = f.batch) > 0)"""

HASH = "CAST('0x' || substring(md5(CAST({} AS VARCHAR)), 1, 8) AS BIGINT)"

PERFORMANCE = SALES + f""", {INVENTORY}, stock AS ({stock()}), joined AS (
    SELECT s.*, COALESCE(i.quantity_on_hand, 0) AS quantity_on_hand
    FROM sales s LEFT JOIN stock i ON s.product_id = i.product_id AND s.store_id = i.store_id)"""
PRODUCT_PERFORMANCE = f"""WITH {PERFORMANCE} SELECT product_id, CAST(SUM(total_quantity) AS BIGINT) AS total_units_sold,
    CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    CAST(SUM(quantity_on_hand) AS BIGINT) AS quantity_in_stock FROM joined GROUP BY 1"""
REVENUE = SALES + """, revenue AS (
    SELECT date, store_id, CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS daily_revenue,
    CAST(SUM(total_quantity) AS BIGINT) AS units_sold FROM sales GROUP BY 1, 2)"""
STORES = SALES + """, stores AS (
    SELECT store_id, CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM sales GROUP BY 1)"""
DAILY = f"""daily AS (SELECT device_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
    {mean('temperature')} AS avg_temperature, {mean('humidity')} AS avg_humidity, COUNT(*) AS reading_count
    FROM telemetry GROUP BY 1, 2)"""

CUT = "1998-06-01"
TARGET_COLUMNS = "store_id, product_id, quantity_on_hand, event_time AS last_updated, supplier_id"


def merged(target: str, source: str, keep: str) -> str:
    """Full outer join; ``keep`` is the condition under which the target row stays."""
    return f"""WITH {INVENTORY}, t AS ({stock(where=target)}), s AS ({stock(where=source)})
        SELECT COALESCE(t.store_id, s.store_id) AS store_id, COALESCE(t.product_id, s.product_id) AS product_id,
        CASE WHEN {keep} THEN t.quantity_on_hand ELSE s.quantity_on_hand END AS quantity_on_hand,
        CASE WHEN {keep} THEN t.event_time ELSE s.event_time END AS last_updated,
        CASE WHEN {keep} THEN t.supplier_id ELSE s.supplier_id END AS supplier_id
        FROM t FULL OUTER JOIN s ON t.store_id = s.store_id AND t.product_id = s.product_id"""


def branch(kind: str) -> str:
    return f"""WITH {INVENTORY}, t AS ({stock(where=f"event_time < '{CUT}'")}),
        s AS ({stock(where=f"event_time >= '{CUT}'")})
        SELECT {STOCK_COLUMNS} FROM s WHERE {kind} (SELECT 1 FROM t
        WHERE t.store_id = s.store_id AND t.product_id = s.product_id)"""


def statements() -> dict[str, str]:
    t = f"WITH {TELEMETRY} "
    person = ("first_name", "last_name", "email", "phone", "loyalty_tier")
    return {
        "scan_count": "SELECT COUNT(*) AS rows FROM events",
        "csv_round_trip": t + "SELECT CAST(device_id AS BIGINT) AS device_id, temperature, humidity, status FROM telemetry",
        "external_csv_rows": t + "SELECT CAST(device_id AS BIGINT) AS device_id, temperature, humidity, status FROM telemetry",
        "insert_into_created": f"WITH {TELEMETRY}, {DAILY} SELECT device_id, reading_count, avg_temperature, date FROM daily",
        "replaced_report": f"WITH {TELEMETRY}, {DAILY} SELECT device_id, date, reading_count FROM daily WHERE date >= '2024-01-10'",
        "shared_view_rows": t + "SELECT * FROM telemetry",
        "column_added_to_table": t + """SELECT event_id, status, CASE WHEN status <> 'OK' THEN lower(status) END AS remark,
            'Status of the reading' AS described FROM telemetry""",
        "dropped_tables": t + """SELECT 'kept' AS "table", COUNT(*) AS rows, false AS schema_exists FROM telemetry
            WHERE status = 'OK'""",
        "clustered_read": t + """SELECT event_id, device_id, ts, temperature, status FROM telemetry
            WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND device_id = '3'""",
        "insert_append": f"""WITH {TELEMETRY}, {DAILY} SELECT device_id, date, avg_temperature, reading_count,
            CASE WHEN date >= '2024-01-20' THEN avg_humidity END AS avg_humidity FROM daily""",
        "table_append_mode": f"WITH {TELEMETRY}, {DAILY} SELECT * FROM daily UNION ALL SELECT * FROM daily",
        "days_replaced": f"""WITH {SALES} SELECT date, store_id, product_id, total_quantity,
            CASE WHEN date >= '1998-01-01' THEN CAST(0 AS DOUBLE) ELSE total_revenue END AS total_revenue,
            order_count FROM sales""",
        "encode_events": t + f"""SELECT '{{"device_id":"' || device_id || '","temperature":' || CAST(temperature AS VARCHAR)
            || ',"humidity":' || CAST(humidity AS VARCHAR) || ',"status":"' || status || '","timestamp":"' || {STAMP}
            || '"}}' AS value, device_id, {STAMP} AS stamp FROM telemetry""",
        "json_encode": t + f""", w AS ({windows('telemetry', '1 hour')})
            SELECT '{{"device_id":"' || device_id || '","window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S')
            || '","window_end":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '","avg_temperature":'
            || CAST(avg_temperature AS VARCHAR) || ',"avg_humidity":' || CAST(avg_humidity AS VARCHAR)
            || ',"reading_count":' || reading_count || ',"error_count":' || error_count || '}}' AS value FROM w""",
        "project": f"WITH {MOVIES} SELECT title, year, rating FROM movies",
        "filter_year": f"WITH {MOVIES} SELECT * FROM movies WHERE year >= 2000",
        "filter_rating": f"WITH {RATINGS} SELECT * FROM ratings WHERE rating >= 4.0",
        "filter_anomaly": t + "SELECT * FROM telemetry WHERE status <> 'OK'",
        "low_stock": f"WITH {INVENTORY} SELECT * FROM ({stock()}) WHERE quantity_on_hand < 10",
        "low_stock_report": f"""WITH {INVENTORY} SELECT store_id, product_id, quantity_on_hand, event_time AS last_updated
            FROM ({stock()}) WHERE quantity_on_hand < 10 ORDER BY quantity_on_hand, store_id, product_id""",
        "filter_tier": f"WITH {CUSTOMERS} SELECT * FROM ({people()}) WHERE loyalty_tier = 'PLATINUM'",
        "completed_orders": f"WITH {ORDERS} SELECT * FROM raw_orders WHERE status = 'COMPLETED'",
        "high_temp": t + "SELECT * FROM telemetry WHERE COALESCE(temperature, 0) > 80.0",
        "date_device_avg": t + f"""SELECT {mean('temperature')} AS avg_temp FROM telemetry
            WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND device_id = '3'""",
        "rename_cast": "SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, value AS temperature FROM events",
        "json_parse": "SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "format_report": t + f"""SELECT 'Device: ' || device_id || ' | AvgTemp: ' || CAST({cents('temperature')} // 100 AS VARCHAR)
            || '.' || lpad(CAST({cents('temperature')} % 100 AS VARCHAR), 2, '0') AS line FROM telemetry GROUP BY device_id""",
        "top_rated": f"""WITH {MOVIES} SELECT "movieId", title, year, rating FROM movies
            ORDER BY rating DESC, "movieId" LIMIT 5""",
        "sample_anomalies": t + "SELECT * FROM telemetry WHERE status <> 'OK' ORDER BY event_id LIMIT 10",
        "day_spread": t + f"""SELECT event_id, device_id, TIMESTAMP '2026-06-10 12:00:00'
            - CAST(round({HASH.format('event_id')} / 4294967296.0 * 5) AS INT) * INTERVAL '1 day' AS ts FROM telemetry""",
        "iso_times": t + """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
            ts - INTERVAL '5 minutes' AS five_minutes_ago FROM telemetry""",
        "validate_orders": orders_valid(None),
        "validate_orders_compat": orders_valid("None"),
        "validate_inventory": inventory_valid(False),
        "validate_inventory_keep_zero": inventory_valid(True),
        "validate_customers": CUSTOMERS_VALID,
        "filter_ok": TELEMETRY_OK,
        "dead_letter_counts": ORDER_OUTCOMES,
        "rejected_telemetry": TELEMETRY_REJECTED,
        "contract_violations": ORDER_CODES,
        "contract_violations_inventory": INVENTORY_CODES,
        "contract_violations_customers": CUSTOMER_CODES,
        "total_records": f"WITH {RATINGS} SELECT COUNT(*) AS total_records FROM ratings",
        "genre_avg": f"""WITH {MOVIES}, g AS (SELECT unnest(string_split(genres, '|')) AS genre, rating FROM movies)
            SELECT genre, {mean('rating')} AS avg_rating FROM g GROUP BY 1""",
        "device_avg": t + f"SELECT device_id, {mean('temperature')} AS temperature FROM telemetry GROUP BY 1",
        "user_avg": f"""WITH {RATINGS} SELECT "userId", {mean('rating')} AS avg_rating FROM ratings GROUP BY 1""",
        "movie_stats": f"""WITH {RATINGS} SELECT "movieId", COUNT("movieId") AS count, {mean_2dp('rating')} AS avg_rating
            FROM ratings GROUP BY 1""",
        "device_summary": t + f"""SELECT device_id, {mean_2dp('temperature')} AS avg_temp,
            round(MIN(temperature), 2) AS min_temp, round(MAX(temperature), 2) AS max_temp,
            {mean_2dp('humidity')} AS avg_humidity FROM telemetry GROUP BY 1 ORDER BY avg_temp DESC, device_id""",
        "one_device_avg": t + f"SELECT {mean('temperature')} AS avg_temp FROM telemetry WHERE device_id = '3'",
        "device_daily": f"WITH {TELEMETRY}, {DAILY} SELECT * FROM daily",
        "device_avg_since": t + f"""SELECT device_id, {mean('temperature')} AS avg_temp FROM telemetry
            WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""",
        "sales_daily": f"WITH {SALES} SELECT * FROM sales",
        "daily_store_revenue": f"WITH {REVENUE} SELECT * FROM revenue",
        "store_revenue": f"WITH {STORES} SELECT * FROM stores ORDER BY revenue DESC, store_id",
        "top_stores": f"WITH {STORES} SELECT * FROM stores ORDER BY revenue DESC, store_id LIMIT 5",
        "top_store_days": f"WITH {REVENUE} SELECT * FROM revenue ORDER BY daily_revenue DESC, date, store_id LIMIT 5",
        "dq_revenue": f"""WITH {REVENUE} SELECT 'daily_revenue_not_negative' AS rule,
            COUNT(*) FILTER (WHERE daily_revenue < 0) AS bad_rows,
            COUNT(*) FILTER (WHERE daily_revenue < 0) = 0 AS passed FROM revenue""",
        "latest_inventory": f"WITH {INVENTORY} {stock()}",
        "latest_customer": f"WITH {CUSTOMERS} {people()}",
        "dedup_orders": f"WITH {ORDERS} " + latest(
            "raw_orders", "order_id", "event_time, store_id, product_id, quantity, price, customer_id, status",
            "order_id, store_id, product_id, quantity, price, customer_id, event_time, status",
        ),
        "numbered_devices": f"""WITH m AS (SELECT user_id, {mean('value')} AS temperature FROM events GROUP BY 1)
            SELECT row_number() OVER (ORDER BY user_id) + 1005 AS id, CAST(user_id AS VARCHAR) AS sensor_id,
            temperature FROM m""",
        "late_flags": t + """, a AS (SELECT *, event_id + (event_id * 7919) % 200 AS arrival FROM telemetry),
            s AS (SELECT *, MAX(ts) OVER (PARTITION BY device_id ORDER BY arrival, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a)
            SELECT event_id, device_id, arrival, COALESCE(ts < seen - INTERVAL '120 seconds', false) AS is_late FROM s""",
        "sales_with_stock": f"WITH {PERFORMANCE} SELECT * FROM joined",
        "sales_with_stock_bucketed": f"WITH {PERFORMANCE} SELECT * FROM joined",
        "product_performance": PRODUCT_PERFORMANCE,
        "product_performance_fixed": f"""WITH {PERFORMANCE}, once AS (SELECT product_id, store_id,
            SUM(total_quantity) AS q, SUM(CAST(total_revenue AS DECIMAL(18,2))) AS r, MAX(quantity_on_hand) AS h
            FROM joined GROUP BY 1, 2)
            SELECT product_id, CAST(SUM(q) AS BIGINT) AS total_units_sold, CAST(SUM(r) AS DOUBLE) AS total_revenue,
            CAST(SUM(h) AS BIGINT) AS quantity_in_stock FROM once GROUP BY 1""",
        "merge_inventory": merged(f"event_time < '{CUT}'", f"event_time >= '{CUT}'", "s.store_id IS NULL"),
        "merge_guarded": merged(
            "quantity_on_hand >= 25", "quantity_on_hand < 25",
            "s.store_id IS NULL OR (t.store_id IS NOT NULL AND s.event_time <= t.event_time)",
        ),
        "merge_inserts": branch("NOT EXISTS"),
        "merge_updates": branch("EXISTS"),
        "merge_customer": f"""WITH {CUSTOMERS}, t AS ({people(f"event_time < '{CUT}'")}),
            s AS ({people(f"event_time >= '{CUT}'")})
            SELECT COALESCE(s.customer_id, t.customer_id) AS customer_id, """
        + ", ".join(f"CASE WHEN s.customer_id IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in person)
        + """, CASE WHEN s.customer_id IS NULL THEN t.event_time ELSE s.event_time END AS last_updated_time
            FROM t FULL OUTER JOIN s ON t.customer_id = s.customer_id""",
        "update_where": t + """SELECT event_id, device_id, ts, temperature,
            CASE WHEN device_id = '3' THEN humidity + 0.5 ELSE humidity END AS humidity, status FROM telemetry""",
        "delete_where": t + "SELECT * FROM telemetry WHERE NOT COALESCE(temperature > 30.0, false)",
        "snapshot_log": """WITH days AS (SELECT CAST(ts AS DATE) AS day, MAX(ts) AS committed_at, COUNT(*) AS added_rows
            FROM events GROUP BY 1), v AS (SELECT *, row_number() OVER (ORDER BY day) AS version FROM days)
            SELECT version, CAST(CASE WHEN version > 1 THEN version - 1 END AS DOUBLE) AS parent, committed_at,
            'append' AS operation, added_rows, CAST(SUM(added_rows) OVER (ORDER BY version) AS BIGINT) AS total_rows FROM v""",
        "commit_summary": f"""WITH {CHANGES} SELECT version, MAX(event_time) AS committed_at,
            COUNT(*) FILTER (WHERE op = 'upsert') AS upserts, COUNT(*) FILTER (WHERE op = 'delete') AS deletes
            FROM changes GROUP BY 1""",
        "as_of_version": f"WITH {CHANGES} {state('version <= 7')}",
        "as_of_time": f"""WITH {CHANGES}, moments AS (SELECT version, MAX(event_time) AS committed_at FROM changes GROUP BY 1)
            {state("version <= (SELECT MAX(a.version) FROM moments a WHERE a.committed_at <= '2000-01-15T00:00:00Z')")}""",
        "current_state": f"WITH {CHANGES} {state('true')}",
        "version_diff": f"""WITH {CHANGES}, a AS ({state('version <= 7')}), b AS ({state('version <= 8')})
            SELECT COALESCE(a.store_id, b.store_id) AS store_id, COALESCE(a.product_id, b.product_id) AS product_id,
            CASE WHEN a.store_id IS NULL THEN 'added' WHEN b.store_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
            CAST(a.quantity_on_hand AS DOUBLE) AS quantity_before, CAST(b.quantity_on_hand AS DOUBLE) AS quantity_after
            FROM a FULL OUTER JOIN b ON a.store_id = b.store_id AND a.product_id = b.product_id
            WHERE a.store_id IS NULL OR b.store_id IS NULL OR a.quantity_on_hand <> b.quantity_on_hand
            OR a.supplier_id <> b.supplier_id OR a.event_time <> b.event_time""",
        "expire_keeps_state": f"WITH {CHANGES} {state('version <= 8')}",
        "expire_by_age": f"WITH {CHANGES} {state('true')}",
        "rollback_state": f"WITH {CHANGES} {state('version <= 7')}",
        "stored_version": f"WITH {CHANGES} {state('version <= 7')}",
        "expired_log": f"""WITH {CHANGES}, left_ AS (SELECT CAST(5 AS BIGINT) AS version, 'upsert' AS op FROM ({state('version <= 5')})
            UNION ALL SELECT version, op FROM changes WHERE version > 5)
            SELECT version, op, COUNT(*) AS rows, (SELECT COUNT(*) FROM changes WHERE version <= 5) AS folded_rows
            FROM left_ GROUP BY 1, 2""",
        "stored_history": t + """SELECT event_id, device_id, ts, temperature,
            CASE WHEN device_id = '3' THEN humidity + 0.5 ELSE humidity END AS humidity, status FROM telemetry""",
        "stored_commits": t + """SELECT CAST(1 AS BIGINT) AS version, CAST(NULL AS DOUBLE) AS parent,
            TIMESTAMP '2026-06-10 10:00:00' AS committed_at, 'insert' AS operation, COUNT(*) AS upserts,
            CAST(0 AS BIGINT) AS deletes FROM telemetry
            UNION ALL SELECT 2, 1, TIMESTAMP '2026-06-10 12:00:00', 'delete', 0, COUNT(*) FROM telemetry
            WHERE temperature > 30.0""",
        "file_records": t + """SELECT 'PARQUET' AS file_format, 'status=' || status AS partition,
            COUNT(*) AS record_count FROM telemetry GROUP BY 1, 2""",
        "evolve_add": t + """SELECT event_id, device_id, ts, temperature, humidity, status,
            CASE WHEN status <> 'OK' THEN status END AS remark FROM telemetry""",
        "evolve_rename": t + """SELECT event_id, device_id, ts, temperature, humidity, status,
            CASE WHEN status <> 'OK' THEN status END AS notes FROM telemetry""",
        "evolve_drop": t + """SELECT event_id, device_id, ts, temperature, humidity, status,
            CAST(NULL AS VARCHAR) AS remark FROM telemetry""",
        "layout_evolution": t + "SELECT * FROM telemetry",
        "bucket_counts": t + f"""SELECT {HASH.format('device_id')} % 10 AS bucket, COUNT(*) AS rows
            FROM telemetry GROUP BY 1""",
        "partition_preserves_rows": f"WITH {RATINGS} SELECT * FROM ratings",
        "partition_rows": "SELECT CAST(4 AS BIGINT) AS partitions, COUNT(*) AS rows FROM lineitem",
        "compacted": t + "SELECT * FROM telemetry",
        "compacted_by_size": t + """SELECT status, CAST(1 AS BIGINT) AS files, COUNT(*) AS rows, status = 'OK' AS rewritten
            FROM telemetry GROUP BY 1""",
        "retain_recent": t + """SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM telemetry
            WHERE CAST(ts AS DATE) >= DATE '2024-01-23'""",
        "tumbling_hour": tumbling("1 hour"),
        "tumbling_minute": tumbling("1 minute"),
        "sliding_hour": SLIDES,
        "session_30m": f"""WITH {TELEMETRY}, {session_rows('telemetry', '30 minutes')}
            SELECT device_id, window_start, window_end, reading_count, avg_temperature FROM sessions""",
        "device_windows": t + windows("telemetry", "1 hour"),
        "readings": READINGS + " SELECT * FROM readings",
        "stream_filter_ok": TELEMETRY_OK,
        "stream_resumed": TELEMETRY_OK,
        "stream_every_second": TELEMETRY_OK,
        "stream_dead_letters": ORDER_OUTCOMES,
        "stream_three_sources": _three_sources(),
        "stream_checked_orders": CHECKED_ORDERS,
        "stream_checked_rejects": CHECKED_REJECTS,
        "stream_closed_windows": READINGS + f" SELECT * FROM ({windows('readings', '1 hour')}) WHERE true{CLOSED}",
        "stream_window_updates": READINGS + " " + windows("readings", "1 hour"),
        "stream_window_panes": PANES,
        "stream_late_tags": f"""WITH {REPLAYED}, seen AS (SELECT *, MAX(ts) OVER (PARTITION BY device_id
            ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM dealt)
            SELECT event_id, device_id, arrival, COALESCE(ts < peak - INTERVAL '120 seconds', false) AS is_late FROM seen""",
        "stream_sessions": READINGS + f""", {session_rows('readings', '30 minutes')}
            SELECT device_id, window_start, window_end, reading_count, avg_temperature FROM sessions WHERE true{CLOSED}""",
        "stream_dedup": fields(ORDER_MESSAGES, *ORDER_FIELDS)
        + f"SELECT DISTINCT order_id_s AS order_id FROM f WHERE is_object AND {ORDER_REQUIRED} AND {ORDER_READABLE}",
        "stream_current_inventory": fields(INVENTORY_MESSAGES, *INVENTORY_FIELDS)
        + f", valid AS ({inventory_select(False)}) "
        + latest(
            "valid", "store_id, product_id",
            "event_time DESC, quantity_on_hand DESC, last_restocked DESC, supplier_id DESC",
            "store_id, product_id, quantity_on_hand, last_restocked, supplier_id, event_time",
        ),
        "stream_by_day": READINGS
        + " SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, COUNT(*) AS rows FROM readings GROUP BY 1",
        "written_days": f"""WITH {ORDERS} SELECT substring(event_time, 1, 10) AS date, COUNT(order_id) AS orders
            FROM raw_orders GROUP BY 1""",
        "curated_run": PRODUCT_PERFORMANCE,
        "curated_sales": f"WITH {SALES} SELECT * FROM sales",
        "curated_inventory": f"WITH {INVENTORY}, s AS ({stock()}) SELECT {TARGET_COLUMNS} FROM s",
        "curated_customers": f"""WITH {CUSTOMERS}, s AS ({people()}) SELECT customer_id, first_name, last_name, email, phone,
            loyalty_tier, event_time AS last_updated_time FROM s""",
        "curated_revenue": f"WITH {REVENUE} SELECT * FROM revenue",
    }


def _three_sources() -> str:
    parts = {
        "orders": orders_valid(None),
        "inventory": inventory_valid(False),
        "customers": CUSTOMERS_VALID,
    }
    return " UNION ALL ".join(f"SELECT '{k}' AS kind, COUNT(*) AS rows FROM ({sql})" for k, sql in parts.items())

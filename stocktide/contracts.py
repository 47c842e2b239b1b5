"""Event contracts and other agreed values."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values. They are part of the agreed data contracts and have to be equal
# for results to be equal; everything else in the library is derived from them.
# ---------------------------------------------------------------------------

ORDER_STATUSES = ["COMPLETED", "RETURNED", "CANCELLED"]
LOYALTY_TIERS = ["BRONZE", "SILVER", "GOLD", "PLATINUM"]

# JSON Schema (draft-07 vocabulary) per event kind.
ORDER_CONTRACT = {
    "properties": {
        "order_id": {"type": "string"},
        "store_id": {"type": "string"},
        "product_id": {"type": "string"},
        "quantity": {"type": "integer", "minimum": 1},
        "price": {"type": "number", "minimum": 0.01},
        "customer_id": {"type": "string"},
        "event_time": {"type": "string", "format": "date-time"},
        "status": {"type": "string", "enum": ORDER_STATUSES},
    },
    "required": ["order_id", "store_id", "product_id", "quantity", "price", "event_time"],
}
INVENTORY_CONTRACT = {
    "properties": {
        "store_id": {"type": "string"},
        "product_id": {"type": "string"},
        "quantity_on_hand": {"type": "integer", "minimum": 0},
        "last_restocked": {"type": "string", "format": "date-time"},
        "supplier_id": {"type": "string"},
        "event_time": {"type": "string", "format": "date-time"},
    },
    "required": ["store_id", "product_id", "quantity_on_hand", "event_time"],
}
CUSTOMER_CONTRACT = {
    "properties": {
        "customer_id": {"type": "string"},
        "first_name": {"type": "string"},
        "last_name": {"type": "string"},
        "email": {"type": "string", "format": "email"},
        "phone": {"type": "string"},
        "loyalty_tier": {"type": "string", "enum": LOYALTY_TIERS},
        "signup_date": {"type": "string", "format": "date"},
        "event_time": {"type": "string", "format": "date-time"},
    },
    "required": ["customer_id", "email", "loyalty_tier", "event_time"],
}

DEFAULT_CUSTOMER = "ANONYMOUS"
DEFAULT_ORDER_STATUS = "COMPLETED"
DEFAULT_SUPPLIER = "UNKNOWN"
DEFAULT_TIER = "BRONZE"

OK_STATUS = "OK"
ERROR_STATUS = "ERROR"
HIGH_TEMPERATURE = 80.0

WINDOW = "60 seconds"
SLIDE = "30 seconds"
ALLOWED_LATENESS = "120 seconds"
COMMIT_INTERVAL = "30 seconds"
FIRST_NUMBERED_ID = 1006
BUCKETS = 10
SPREAD_DAYS = 5
KEEP_VERSIONS_DAYS = 7
KEEP_RAW_DAYS = 30
DEVICE_REPORT = "Device: %s | AvgTemp: %.2f"
# ---------------------------------------------------------------------------
TARGET_FILE_BYTES = 128 << 20
JOIN_BUCKETS = 16
STORE_GROUPS = 64  # folders of a stock table by groups of stores; kept for the life of the table

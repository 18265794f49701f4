"""Record schemas and the transaction contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the payments domain.
CURRENCIES = ["CAD", "USD", "EUR", "GBP"]
PAYMENT_METHODS = ["credit_card", "debit_card", "e_transfer", "apple_pay", "google_pay"]
STATUSES = ["approved", "declined", "pending"]
MERCHANT_CATEGORIES = [
    "grocery",
    "electronics",
    "clothing",
    "restaurant",
    "travel",
    "entertainment",
    "health",
    "gas_station",
    "subscription",
    "marketplace",
]
TXN_ID_PATTERN = "^[a-f0-9]{24}$"
USER_ID_PATTERN = r"^user_\d{6}$"
MERCHANT_ID_PATTERN = r"^merchant_\d{4}$"

LOCATION = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

#: JSON payload of a transaction; the time stays text until `event_time` reads it
TRANSACTION_JSON = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("location", LOCATION),
    ]
)

SCORE_FIELDS = [
    T.StructField("user_txn_count", T.LongType()),
    T.StructField("user_running_mean", T.DoubleType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()),
]

#: JSON payload of a scored transaction
ENRICHED_JSON = T.StructType(TRANSACTION_JSON.fields + SCORE_FIELDS)

#: JSON payload of a closed daily window, bounds in epoch milliseconds
DAILY_SPEND_JSON = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("window_start", T.LongType()),
        T.StructField("window_end", T.LongType()),
        T.StructField("txn_count", T.LongType()),
        T.StructField("total_spend", T.DoubleType()),
        T.StructField("avg_spend", T.DoubleType()),
    ]
)

_SNAPSHOT_COMMON = (
    "txn_id string, user_id string, amount double, currency string, timestamp timestamp, "
    "merchant_id string, merchant_category string, payment_method string"
)
SNAPSHOT_TRANSACTIONS = (
    f"{_SNAPSHOT_COMMON}, status string, location_lat double, location_lon double, "
    "user_txn_count bigint, user_running_mean double, z_score double, is_anomaly boolean"
)
SNAPSHOT_ANOMALIES = f"{_SNAPSHOT_COMMON}, z_score double, user_running_mean double, user_txn_count bigint"

#: field -> rule; `fields` nests. Used by `operators.contract`.
TRANSACTION_CONTRACT = {
    "txn_id": {"type": "string", "pattern": TXN_ID_PATTERN},
    "user_id": {"type": "string", "pattern": USER_ID_PATTERN},
    "amount": {"type": "number", "minimum": 0.01, "maximum": 15000.0},
    "currency": {"type": "string", "enum": CURRENCIES},
    "timestamp": {"type": "string", "format": "date-time"},
    "merchant_id": {"type": "string", "pattern": MERCHANT_ID_PATTERN},
    "merchant_category": {"type": "string", "enum": MERCHANT_CATEGORIES},
    "payment_method": {"type": "string", "enum": PAYMENT_METHODS},
    "status": {"type": "string", "enum": STATUSES},
    "location": {
        "type": "object",
        "fields": {
            "lat": {"type": "number", "minimum": -90.0, "maximum": 90.0},
            "lon": {"type": "number", "minimum": -180.0, "maximum": 180.0},
        },
    },
}

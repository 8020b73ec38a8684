"""Fixed schemas, field lists and allowed values of the order-event lake."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the event contract.
SCHEMA_VERSION = 1
REQUIRED_FIELDS = (
    "event_id",
    "event_type",
    "event_timestamp",
    "order_id",
    "product_id",
    "category",
    "quantity",
    "unit_price",
    "currency",
)
EVENT_TYPES = ("order_created",)
CURRENCIES = ("GBP",)
CATEGORIES = ("electronics", "home", "fashion", "sports", "books")
# A repair may never change who an event is or when it happened.
IDENTITY_FIELDS = ("event_id", "event_timestamp")
TOPIC = "orders"
DATASET = "silver_orders"
# ---------------------------------------------------------------------------

MONEY_PRICE = T.DecimalType(12, 2)
MONEY_VALUE = T.DecimalType(14, 2)
MONEY_TOTAL = T.DecimalType(24, 2)
STRING, BINARY, INT, LONG = T.StringType(), T.BinaryType(), T.IntegerType(), T.LongType()
DOUBLE, DATE, TIMESTAMP = T.DoubleType(), T.DateType(), T.TimestampType()
TEXT_MAP = T.MapType(STRING, STRING)

ORDER_EVENT = T.StructType(
    [
        T.StructField("schema_version", INT),
        T.StructField("event_id", STRING),
        T.StructField("event_type", STRING),
        T.StructField("event_timestamp", STRING),
        T.StructField("order_id", STRING),
        T.StructField("customer_id", STRING),
        T.StructField("product_id", STRING),
        T.StructField("category", STRING),
        T.StructField("quantity", INT),
        T.StructField("unit_price", DOUBLE),
        T.StructField("currency", STRING),
    ]
)

# What the console tail shows: the event before versioning, no validation.
TAIL_EVENT = T.StructType([f for f in ORDER_EVENT if f.name != "schema_version"])

MESSAGE = T.StructType(
    [
        T.StructField("key", BINARY),
        T.StructField("value", BINARY),
        T.StructField("topic", STRING),
        T.StructField("partition", INT),
        T.StructField("offset", LONG),
        T.StructField("timestamp", TIMESTAMP),
    ]
)

# A message as the topic gives it, with its headers; most have none.
HEADED_MESSAGE = T.StructType(
    [
        *MESSAGE.fields,
        T.StructField(
            "headers",
            T.ArrayType(T.StructType([T.StructField("key", STRING), T.StructField("value", BINARY)])),
        ),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("kafka_key", STRING),
        T.StructField("raw_payload", STRING),
        T.StructField("topic", STRING),
        T.StructField("partition", INT),
        T.StructField("offset", LONG),
        T.StructField("kafka_timestamp", TIMESTAMP),
        T.StructField("ingested_at", TIMESTAMP),
        T.StructField("ingestion_date", DATE),
    ]
)

# ingestion_hour is written as two digits and read back as a number.
SILVER = T.StructType(
    [
        T.StructField("event_id", STRING),
        T.StructField("event_type", STRING),
        T.StructField("event_timestamp", TIMESTAMP),
        T.StructField("event_date", DATE),
        T.StructField("order_id", STRING),
        T.StructField("customer_id", STRING),
        T.StructField("product_id", STRING),
        T.StructField("category", STRING),
        T.StructField("quantity", INT),
        T.StructField("unit_price", DOUBLE),
        T.StructField("order_value", DOUBLE),
        T.StructField("currency", STRING),
        T.StructField("kafka_key", STRING),
        T.StructField("topic", STRING),
        T.StructField("partition", INT),
        T.StructField("offset", LONG),
        T.StructField("kafka_timestamp", TIMESTAMP),
        T.StructField("ingested_at", TIMESTAMP),
        T.StructField("ingestion_date", DATE),
        T.StructField("ingestion_hour", INT),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("raw_payload", STRING),
        T.StructField("schema_version", INT),
        T.StructField("contract_error", STRING),
        T.StructField("validation_error", STRING),
        T.StructField("topic", STRING),
        T.StructField("partition", INT),
        T.StructField("offset", LONG),
        T.StructField("kafka_timestamp", TIMESTAMP),
        T.StructField("ingested_at", TIMESTAMP),
    ]
)

RAW_ORDERS = T.StructType(
    [
        T.StructField("event_id", STRING),
        T.StructField("event_type", STRING),
        T.StructField("event_timestamp", TIMESTAMP),
        T.StructField("event_date", DATE),
        T.StructField("order_id", STRING),
        T.StructField("customer_id", STRING),
        T.StructField("product_id", STRING),
        T.StructField("category", STRING),
        T.StructField("quantity", INT),
        T.StructField("unit_price", MONEY_PRICE),
        T.StructField("order_value", MONEY_VALUE),
        T.StructField("currency", STRING),
        T.StructField("kafka_key", STRING),
        T.StructField("kafka_topic", STRING),
        T.StructField("kafka_partition", INT),
        T.StructField("kafka_offset", LONG),
        T.StructField("kafka_timestamp", TIMESTAMP),
        T.StructField("ingested_at", TIMESTAMP),
        T.StructField("loaded_at", TIMESTAMP),
    ]
)

FACT_ORDERS = T.StructType(
    [
        T.StructField("event_id", STRING),
        T.StructField("order_id", STRING),
        T.StructField("customer_id", STRING),
        T.StructField("product_id", STRING),
        T.StructField("ordered_at", TIMESTAMP),
        T.StructField("event_date", DATE),
        T.StructField("category", STRING),
        T.StructField("quantity", INT),
        T.StructField("unit_price", MONEY_PRICE),
        T.StructField("order_value", MONEY_VALUE),
        T.StructField("currency", STRING),
        T.StructField("loaded_at", TIMESTAMP),
    ]
)

DAILY_SALES = T.StructType(
    [
        T.StructField("event_date", DATE),
        T.StructField("order_count", LONG),
        T.StructField("units_sold", LONG),
        T.StructField("gross_revenue", MONEY_TOTAL),
        T.StructField("average_order_value", MONEY_VALUE),
    ]
)

# What the daily sales are worked out from; sums that rows can be taken out of again.
DAILY_TOTALS = T.StructType(
    [
        T.StructField("event_date", DATE),
        T.StructField("order_count", LONG),
        T.StructField("units_sold", LONG),
        T.StructField("with_units", LONG),
        T.StructField("total", MONEY_TOTAL),
        T.StructField("valued", LONG),
    ]
)

LOADED_FILES = T.StructType(
    [
        T.StructField("file_path", STRING),
        T.StructField("dataset_name", STRING),
        T.StructField("ingestion_date", DATE),
        T.StructField("ingestion_hour", INT),
        T.StructField("row_count", LONG),
        T.StructField("loaded_at", TIMESTAMP),
    ]
)

SILVER_EVENTS = T.StructType(
    [
        T.StructField("event_id", STRING),
    ]
)
COUNTED_FILES = T.StructType(
    [
        T.StructField("file_path", STRING),
        T.StructField("row_count", LONG),
    ]
)

WATERMARKS = T.StructType(
    [
        T.StructField("dataset_name", STRING),
        T.StructField("watermark_date", DATE),
        T.StructField("watermark_hour", INT),
        T.StructField("updated_at", TIMESTAMP),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("metric_id", STRING),
        T.StructField("recorded_at", TIMESTAMP),
        T.StructField("bronze_rows", LONG),
        T.StructField("silver_rows", LONG),
        T.StructField("silver_unique_events", LONG),
        T.StructField("quarantine_rows", LONG),
        T.StructField("raw_orders", LONG),
        T.StructField("fact_orders", LONG),
        T.StructField("gold_order_count", LONG),
        T.StructField("latest_loaded_at", TIMESTAMP),
        T.StructField("status", STRING),
        T.StructField("details", STRING),
    ]
)

RUN_COLUMNS = T.StructType(
    [
        T.StructField("loader_files_discovered", LONG),
        T.StructField("loader_files_skipped", LONG),
        T.StructField("loader_files_loaded", LONG),
        T.StructField("loader_rows_processed", LONG),
        T.StructField("loader_rows_inserted", LONG),
        T.StructField("loader_duplicates", LONG),
        T.StructField("dbt_status", STRING),
        T.StructField("health_status", STRING),
        T.StructField("raw_orders", LONG),
        T.StructField("latest_load", TIMESTAMP),
        T.StructField("status", STRING),
        T.StructField("error_message", STRING),
        T.StructField("finished_at", TIMESTAMP),
    ]
)
RUN_EVENTS = T.StructType(
    [
        T.StructField("run_id", STRING),
        T.StructField("event", STRING),
        T.StructField("event_at", TIMESTAMP),
        *RUN_COLUMNS.fields,
    ]
)

INCIDENTS = T.StructType(
    [
        T.StructField("incident_id", STRING),
        T.StructField("incident_type", STRING),
        T.StructField("severity", STRING),
        T.StructField("details", STRING),
        T.StructField("opened_at", TIMESTAMP),
        T.StructField("resolved_at", TIMESTAMP),
        T.StructField("opened_by_run_id", STRING),
        T.StructField("resolved_by_run_id", STRING),
        T.StructField("alert_sent_at", TIMESTAMP),
        T.StructField("recovery_sent_at", TIMESTAMP),
        T.StructField("transition", STRING),
        T.StructField("changed_at", TIMESTAMP),
    ]
)

# A stamp per notice that went out: of an opened incident (ALERT) or a resolved one (RECOVERY).
NOTICE_STAMPS = T.StructType(
    [
        T.StructField("incident_id", STRING),
        T.StructField("notice", STRING),
        T.StructField("sent_at", TIMESTAMP),
    ]
)

REPAIR_REQUESTS = T.StructType(
    [
        T.StructField("event_id", STRING),
        T.StructField("corrections", TEXT_MAP),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("reprocessing_id", STRING),
        T.StructField("event_id", STRING),
        T.StructField("order_id", STRING),
        T.StructField("original_contract_error", STRING),
        T.StructField("original_validation_error", STRING),
        T.StructField("original_kafka_timestamp", TIMESTAMP),
        T.StructField("corrections", STRING),
        T.StructField("action", STRING),
        T.StructField("status", STRING),
        T.StructField("republished_topic", STRING),
        T.StructField("republished_partition", INT),
        T.StructField("republished_offset", LONG),
        T.StructField("error_message", STRING),
        T.StructField("created_at", TIMESTAMP),
    ]
)

POSITIONS = T.StructType(
    [
        T.StructField("reprocessing_id", STRING),
        T.StructField("republished_topic", STRING),
        T.StructField("republished_partition", INT),
        T.StructField("republished_offset", LONG),
    ]
)

ORDER_KEY_MAP = T.StructType(
    [
        T.StructField("event_id", STRING),
        T.StructField("old_order_id", STRING),
        T.StructField("new_order_id", STRING),
    ]
)
ORDER_KEY_REPAIRS = T.StructType(
    [
        T.StructField("event_id", STRING),
        T.StructField("old_order_id", STRING),
        T.StructField("new_order_id", STRING),
        T.StructField("outcome", STRING),
        T.StructField("applied_at", TIMESTAMP),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values of the control tables.
RUN_STATUSES = ("RUNNING", "SUCCEEDED", "FAILED")
MODEL_STATUSES = ("SUCCEEDED", "FAILED")
HEALTH_STATUSES = ("HEALTHY", "WARNING", "DEGRADED")
INCIDENT_SEVERITIES = ("WARNING", "DEGRADED")
AUDIT_ACTIONS = ("DRY_RUN", "PUBLISH")
AUDIT_STATUSES = ("DRY_RUN", "PUBLISHED", "PUBLISH_FAILED")
# ---------------------------------------------------------------------------

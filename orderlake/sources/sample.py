"""A delivery log derived from the ``lineitem`` table, one message per row.

The test tables carry no order events, so every line item becomes one JSON
message. Where the order key leaves certain remainders modulo 29 the payload gets
a fault, so each error code occurs; ``(order key, line number)`` repeats in the
table, so duplicate deliveries occur too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas as S

_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
)

# Fault by order key modulo 29: which remainder changes what (the test tables' fixed rule).
NOT_JSON, NO_VERSION, VERSION_99, NO_ORDER_ID, ZERO_QUANTITY = 0, 1, 2, 3, 4
USD, BAD_TIME, BAD_CATEGORY, BLANK_EVENT_ID = 5, 6, 7, 8
EXTRA_FIELD, BAD_TYPE, ZERO_PRICE, TEXT_VERSION = 9, 10, 11, 12

EXPECTED_CODES = {
    NOT_JSON: "contract_invalid_payload",
    NO_VERSION: "contract_missing_schema_version",
    VERSION_99: "contract_unsupported_schema_version",
    NO_ORDER_ID: "contract_missing_order_id",
    ZERO_QUANTITY: "invalid_quantity",
    USD: "unsupported_currency",
    BAD_TIME: "invalid_event_timestamp",
    BAD_CATEGORY: "unsupported_category",
    BLANK_EVENT_ID: "missing_or_invalid_event_id",
    BAD_TYPE: "unsupported_event_type",
    ZERO_PRICE: "invalid_unit_price",
    TEXT_VERSION: "contract_invalid_schema_version",
}

# An offset reads: part (5 more digits: supplier), line, last three digits of the order.
_OFFSETS_PER_PART = 100_000 * 8 * 1000
PARTS_PER_FILE = 1000
BYTES_PER_TASK = 8 << 20  # of the table on disk, some five times as much in a shuffle


def read_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns deliveries need."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*_COLUMNS)


def by_day(lineitem: DataFrame, bytes_read: int) -> DataFrame:
    """Rows of a day in one task, so that a day is one file of a layer; tasks in step with the table's bytes on disk."""
    tasks = max(int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bytes_read // BYTES_PER_TASK))
    return lineitem.repartition(tasks, "l_shipdate")


def fault() -> Column:
    return F.col("l_orderkey") % 29


# The payload of a line item, its fault at the place the remainder says.
_PAYLOAD = f"""
CASE WHEN l_orderkey % 29 = {NOT_JSON} THEN 'not json' ELSE concat(
  '{{',
  CASE l_orderkey % 29
    WHEN {NO_VERSION} THEN ''
    WHEN {VERSION_99} THEN '"schema_version":99,'
    WHEN {TEXT_VERSION} THEN '"schema_version":"x",'
    ELSE '"schema_version":1,' END,
  '"event_id":"', if(l_orderkey % 29 = {BLANK_EVENT_ID}, ' ', concat('evt-', l_orderkey, '-', l_linenumber)),
  '","event_type":"', if(l_orderkey % 29 = {BAD_TYPE}, 'order_deleted', 'order_created'),
  '","event_timestamp":"', if(l_orderkey % 29 = {BAD_TIME}, 'not-a-timestamp',
                              concat(cast(l_shipdate AS date), 'T00:00:00+00:00')),
  '",', if(l_orderkey % 29 = {NO_ORDER_ID}, '', concat('"order_id":"ORD-', l_orderkey, '",')),
  '"product_id":"PRD-', l_partkey,
  '","category":"', if(l_orderkey % 29 = {BAD_CATEGORY}, 'automotive', 'home'),
  '","quantity":', if(l_orderkey % 29 = {ZERO_QUANTITY}, '0', cast(cast(l_quantity AS int) AS string)),
  ',"unit_price":', if(l_orderkey % 29 = {ZERO_PRICE}, '0', cast(cast(l_extendedprice AS decimal(12,2)) AS string)),
  ',"currency":"', if(l_orderkey % 29 = {USD}, 'USD', 'GBP'), '"',
  if(l_orderkey % 29 = {EXTRA_FIELD}, ',"promotion_code":"SPRING"', ''),
  '}}') END
"""

# Microseconds of the ingest time: an interval added to a timestamp goes through the time zone, on every row.
_INGESTED = """
unix_micros(cast(l_shipdate AS timestamp)) + (dayofmonth(l_shipdate) % 24 * 3600L + l_suppkey % 60) * 1000000L
"""

_ON_THE_WAY = 30 * 60 * 1_000_000

_OFFSET = "((l_partkey * 100000 + l_suppkey) * 8 + l_linenumber) * 1000 + l_orderkey % 1000"


def messages(lineitem: DataFrame) -> DataFrame:
    """Messages in the shape of a topic; works on a batch or a streaming ``lineitem``.

    A message reaches the broker half an hour before it is ingested; it is ingested
    on its ship date, in the hour given by the day of the month.
    """
    return lineitem.selectExpr(
        "cast(concat('ORD-', l_orderkey) AS binary) AS key",
        f"cast({_PAYLOAD} AS binary) AS value",
        f"'{S.TOPIC}' AS topic",
        "cast(l_suppkey % 3 AS int) AS `partition`",
        f"{_OFFSET} AS `offset`",
        f"timestamp_micros({_INGESTED} - {_ON_THE_WAY}) AS timestamp",
    )


def ingest_time() -> Column:
    """Ingest time of a derived message, over a frame of messages."""
    return F.expr(f"timestamp_micros(unix_micros(timestamp) + {_ON_THE_WAY})")


# The file of a delivery within its hour.
FILE_NUMBER = f"lpad(`offset` div {_OFFSETS_PER_PART * PARTS_PER_FILE}, 5, '0')"


def with_file_position(silver: DataFrame) -> DataFrame:
    """Stand-in for the file path and row index a real Silver table has."""
    folder = "'silver/ingestion_date=', ingestion_date, '/ingestion_hour=', ingestion_hour"
    return silver.selectExpr(
        "*", f"concat({folder}, '/part-', {FILE_NUMBER}, '.parquet') AS file_path", "`offset` AS row_index"
    )


# Total order of the derived deliveries: load order, then what may still differ.
SAMPLE_ORDER = ("ingestion_date", "ingestion_hour", "file_path", "row_index", "quantity", "unit_price")

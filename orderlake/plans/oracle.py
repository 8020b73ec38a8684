"""The catalog's queries in plain SQL for DuckDB, to check results against.

Written from the meaning of each query, not from its plan: joins, windows and
aggregates over the same tables. Common table expressions are named and each query
lists the ones it starts from.
"""

from __future__ import annotations

_CODES = """
case when {p} is null or not json_valid({p}) then 'contract_invalid_payload'
     when json_type({p}) <> 'OBJECT' then 'contract_invalid_payload'
     when {p} ->> '$.schema_version' is null then 'contract_missing_schema_version'
     when try_cast({p} ->> '$.schema_version' as integer) is null then 'contract_invalid_schema_version'
     when try_cast({p} ->> '$.schema_version' as integer) <> 1 then 'contract_unsupported_schema_version'
     when {p} ->> '$.event_id' is null then 'contract_missing_event_id'
     when {p} ->> '$.event_type' is null then 'contract_missing_event_type'
     when {p} ->> '$.event_timestamp' is null then 'contract_missing_event_timestamp'
     when {p} ->> '$.order_id' is null then 'contract_missing_order_id'
     when {p} ->> '$.product_id' is null then 'contract_missing_product_id'
     when {p} ->> '$.category' is null then 'contract_missing_category'
     when {p} ->> '$.quantity' is null then 'contract_missing_quantity'
     when {p} ->> '$.unit_price' is null then 'contract_missing_unit_price'
     when {p} ->> '$.currency' is null then 'contract_missing_currency' end
"""

_QUALITY = """
case when {error} is not null then null
     when trim({p} ->> '$.event_id') = '' then 'missing_or_invalid_event_id'
     when trim({p} ->> '$.order_id') = '' then 'missing_order_id'
     when trim({p} ->> '$.product_id') = '' then 'missing_product_id'
     when {p} ->> '$.event_type' not in ('order_created') then 'unsupported_event_type'
     when try_cast({p} ->> '$.event_timestamp' as timestamp) is null then 'invalid_event_timestamp'
     when coalesce(try_cast({p} ->> '$.quantity' as integer), 0) <= 0 then 'invalid_quantity'
     when coalesce(try_cast({p} ->> '$.unit_price' as double), 0) <= 0 then 'invalid_unit_price'
     when {p} ->> '$.currency' not in ('GBP') then 'unsupported_currency'
     when {p} ->> '$.category' not in ('electronics', 'home', 'fashion', 'sports', 'books')
       then 'unsupported_category' end
"""


def _judge(source: str) -> str:
    """Rows of ``source`` with ``js`` (NULL unless JSON) and both error columns."""
    return f"""
select *, {_QUALITY.format(p="js", error="contract_error")} as validation_error
from (select *, {_CODES.format(p="js")} as contract_error
      from (select *, case when json_valid(raw_payload) then raw_payload end as js from {source}))
"""


_VERDICT = """
select *,
  bronze_rows - (silver_rows + quarantine_rows) as bronze_gap,
  coalesce(silver_unique_events, silver_rows) - raw_orders as raw_gap,
  cast(trunc(date_diff('microsecond', latest_loaded_at, checked_at) / 60000000.0) as bigint) as load_age_minutes
from {source}
"""

_FINDINGS = """
select *,
  case when bronze_gap <> 0 then 'Bronze does not reconcile with Silver + Quarantine: ' || bronze_rows || ' != '
    || silver_rows || ' + ' || quarantine_rows || ' (gap=' || bronze_gap || ')' end as t1,
  case when raw_gap <> 0 then 'Silver unique events do not reconcile with raw.orders: ' || silver_unique_events
    || ' != ' || raw_orders || ' (gap=' || raw_gap || ')' end as t2,
  case when raw_orders <> fact_orders then 'raw.orders does not reconcile with fct_orders: ' || raw_orders
    || ' != ' || fact_orders end as t3,
  case when fact_orders <> gold_order_count then 'fct_orders does not reconcile with Gold order count: '
    || fact_orders || ' != ' || gold_order_count end as t4,
  case when latest_loaded_at is null then 'No warehouse load timestamp available'
    when load_age_minutes > 2880 then 'Warehouse data is stale: ' || load_age_minutes
    || ' minutes since latest load' end as t5,
  case when bronze_gap <> 0 and ({strict} or abs(bronze_gap) > {lag}) then 'BRONZE_RECONCILIATION' end as i1,
  case when raw_gap <> 0 and ({strict} or raw_gap < 0 or raw_gap > {lag}) then 'SILVER_RAW_RECONCILIATION' end as i2,
  case when raw_orders <> fact_orders then 'RAW_FACT_RECONCILIATION' end as i3,
  case when fact_orders <> gold_order_count then 'FACT_GOLD_RECONCILIATION' end as i4,
  case when latest_loaded_at is null or load_age_minutes > 2880 then 'WAREHOUSE_FRESHNESS' end as i5
from {source}
"""

_STATUS = """
select *,
  case when concat_ws(',', i1, i2, i3, i4, i5) <> '' then 'DEGRADED'
       when concat_ws('; ', t1, t2, t3, t4, t5) <> '' then 'WARNING' else 'HEALTHY' end as status,
  case when concat_ws('; ', t1, t2, t3, t4, t5) <> '' then concat_ws('; ', t1, t2, t3, t4, t5)
       else 'All reconciliation and freshness checks passed' end as details,
  concat_ws(',', i1, i2, i3, i4, i5) as incident_types
from {source}
"""

_BACKFILL = "ingestion_date between date '1996-03-01' and date '1997-02-28'"
_NORMAL = (
    "(ingestion_date > date '1999-06-30' or (ingestion_date = date '1999-06-30' and ingestion_hour >= 6))"
)
_IS_LOADED = "(ingestion_date <= date '1999-06-30' and day(ingestion_date) % 7 <> 3)"
_ORDER = "ingestion_date, ingestion_hour, file_path, row_index, quantity, unit_price"
_FACT = (
    "event_id, order_id, customer_id, product_id, event_timestamp as ordered_at, event_date, category, "
    "quantity, unit_price, order_value, currency, loaded_at"
)
_RAW = (
    "event_id, event_type, event_timestamp, event_date, order_id, customer_id, product_id, category, quantity, "
    "unit_price, order_value, currency, kafka_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, "
    "ingested_at"
)


def _first_of(source: str) -> str:
    return f"""
select * exclude (_n) from (
  select *, row_number() over (partition by event_id order by {_ORDER}) as _n from {source})
where _n = 1
"""


def _renamed(source: str, extra: str = "") -> str:
    return f"""
select event_id, event_type, event_timestamp, event_date, order_id, customer_id, product_id, category, quantity,
  cast(unit_price as decimal(12,2)) as unit_price, cast(order_value as decimal(14,2)) as order_value, currency,
  kafka_key, topic as kafka_topic, "partition" as kafka_partition, "offset" as kafka_offset,
  kafka_timestamp, ingested_at{extra}
from {source}
"""


def _mart(source: str) -> str:
    return f"""
select event_date, count(*) as order_count, cast(sum(quantity) as bigint) as units_sold,
  cast(sum(cents) as double) / 100 as gross_revenue,
  cast((2 * sum(cents) + count(*)) // (2 * count(*)) as double) / 100 as average_order_value
from (select *, cast(order_value * 100 as bigint) as cents from {source})
group by event_date
"""


def _load_of(mode: str, window: str, wanted: str) -> dict[str, str]:
    return {
        f"files_{mode}": f"""
select f.*, l.file_path is not null as loaded_before, {wanted} as selected
from files f left join ledger l on f.file_path = l.file_path where {window.replace("ingestion_", "f.ingestion_")}
""",
        f"batch_{mode}": _first_of(
            f"(select s.* from silver s join files_{mode} f on s.file_path = f.file_path where f.selected)"
        ),
        f"new_{mode}": f"select * from batch_{mode} where event_id not in (select event_id from raw_before)",
        f"count_{mode}": f"""
select '{mode.upper()}' as mode, count(*) as files_discovered,
  count(*) filter (where not selected) as files_skipped, count(*) filter (where selected) as files_loaded,
  cast(coalesce(sum(row_count) filter (where selected), 0) as bigint) as rows_processed,
  (select count(*) from new_{mode}) as rows_inserted,
  {"max(ingestion_date)" if mode == "normal" else "cast(null as date)"} as watermark_date,
  {"arg_max(ingestion_hour, ingestion_date)" if mode == "normal" else "cast(null as integer)"} as watermark_hour
from files_{mode}
""",
    }


_EVENT_ID = "'evt-' || l_orderkey || '-' || l_linenumber"

CTES: dict[str, str] = {
    "messages": f"""
select 'ORD-' || l_orderkey as kafka_key,
  case when f = 0 then 'not json' else
    '{{' || case f when 1 then '' when 2 then '"schema_version":99,' when 12 then '"schema_version":"x",'
             else '"schema_version":1,' end
    || '"event_id":"' || case when f = 8 then ' ' else {_EVENT_ID} end
    || '","event_type":"' || case when f = 10 then 'order_deleted' else 'order_created' end
    || '","event_timestamp":"' || case when f = 6 then 'not-a-timestamp'
         else strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00+00:00' end || '",'
    || case when f = 3 then '' else '"order_id":"ORD-' || l_orderkey || '",' end
    || '"product_id":"PRD-' || l_partkey
    || '","category":"' || case when f = 7 then 'automotive' else 'home' end
    || '","quantity":' || case when f = 4 then '0' else cast(cast(l_quantity as integer) as varchar) end
    || ',"unit_price":' || case when f = 11 then '0' else cast(cast(l_extendedprice as decimal(12,2)) as varchar) end
    || ',"currency":"' || case when f = 5 then 'USD' else 'GBP' end || '"'
    || case when f = 9 then ',"promotion_code":"SPRING"' else '' end || '}}' end as raw_payload,
  'orders' as topic, cast(l_suppkey % 3 as integer) as "partition",
  cast(((l_partkey * 100000 + l_suppkey) * 8 + l_linenumber) * 1000 + l_orderkey % 1000 as bigint) as "offset",
  l_shipdate + to_hours(day(l_shipdate) % 24) + to_seconds(l_suppkey % 60) as ingested_at
from (select *, l_orderkey % 29 as f from lineitem)
""",
    "bronze": """
select kafka_key, raw_payload, topic, "partition", "offset", ingested_at - interval 30 minute as kafka_timestamp,
  ingested_at, cast(ingested_at - interval 30 minute as date) as ingestion_date
from messages
""",
    "judged": _judge("bronze"),
    "orders_in": """
select js ->> '$.event_id' as event_id, js ->> '$.event_type' as event_type,
  cast(js ->> '$.event_timestamp' as timestamp) as event_timestamp,
  cast(cast(js ->> '$.event_timestamp' as timestamp) as date) as event_date,
  js ->> '$.order_id' as order_id, js ->> '$.customer_id' as customer_id, js ->> '$.product_id' as product_id,
  js ->> '$.category' as category, cast(js ->> '$.quantity' as integer) as quantity,
  cast(js ->> '$.unit_price' as double) as unit_price,
  round(cast(js ->> '$.quantity' as integer) * cast(js ->> '$.unit_price' as double), 2) as order_value,
  js ->> '$.currency' as currency, kafka_key, topic, "partition", "offset", kafka_timestamp, ingested_at,
  cast(ingested_at as date) as ingestion_date, strftime(ingested_at, '%H') as hh
from judged where contract_error is null and validation_error is null
""",
    "silver": """
select * exclude (hh), cast(hh as integer) as ingestion_hour,
  'silver/ingestion_date=' || cast(ingestion_date as varchar) || '/ingestion_hour=' || hh
    || '/part-' || lpad(cast("offset" // 800000000000 as varchar), 5, '0') || '.parquet' as file_path,
  "offset" as row_index
from orders_in
""",
    "quarantine": """
select raw_payload, case when js ->> '$.schema_version' is null then null
    else try_cast(js ->> '$.schema_version' as integer) end as schema_version,
  contract_error, validation_error, topic, "partition", "offset", kafka_timestamp, ingested_at
from judged where contract_error is not null or validation_error is not null
""",
    "first_rows": _first_of("silver"),
    "files": """
select file_path, ingestion_date, ingestion_hour, count(*) as row_count from silver group by all
""",
    "ledger": f"select * from files where {_IS_LOADED}",
    "raw_before": _first_of(f"(select * from silver where {_IS_LOADED})"),
    **_load_of("normal", _NORMAL, "l.file_path is null"),
    **_load_of("backfill", _BACKFILL, "l.file_path is null"),
    **_load_of("replay", _BACKFILL, "true"),
    "raw": _renamed(
        f"""(select *, case when {_IS_LOADED} then timestamp '2002-01-01 00:00:00'
                else timestamp '2002-01-02 00:10:00' end as loaded_at from first_rows)""",
        ", loaded_at",
    ),
    "fact": f"select {_FACT} from raw",
    "fact_before": "select * from fact where loaded_at = timestamp '2002-01-01 00:00:00'",
    "mart": _mart("fact"),
    "day_bronze": "select ingestion_date as day, count(*) as bronze_rows from bronze group by 1",
    "day_routed": """
select cast(ingested_at as date) as day,
  count(*) filter (where contract_error is null and validation_error is null) as silver_rows,
  count(distinct js ->> '$.event_id') filter (where contract_error is null and validation_error is null)
    as silver_unique_events,
  count(*) filter (where contract_error is not null or validation_error is not null) as quarantine_rows
from judged group by 1
""",
    "day_raw": """
select ingestion_date as day, count(*) as raw_orders,
  count(*) filter (where not (day(ingestion_date) = 13 and "partition" = 1)) as fact_orders,
  count(*) filter (where not (day(ingestion_date) = 13 and "partition" = 1)
                     and not (day(ingestion_date) = 17 and "partition" = 2)) as gold_order_count,
  max(ingested_at) + interval 10 minute as latest_loaded_at
from first_rows group by 1
""",
    "daily": """
select day, coalesce(bronze_rows, 0) as bronze_rows, coalesce(silver_rows, 0) as silver_rows,
  coalesce(silver_unique_events, 0) as silver_unique_events, coalesce(quarantine_rows, 0) as quarantine_rows,
  coalesce(raw_orders, 0) as raw_orders, coalesce(fact_orders, 0) as fact_orders,
  coalesce(gold_order_count, 0) as gold_order_count, latest_loaded_at,
  cast(day as timestamp) + to_hours(24 + 2 * day(day)) as recorded_at,
  cast(day as timestamp) + to_hours(24 + 2 * day(day)) as checked_at
from day_bronze full join day_routed using (day) full join day_raw using (day)
""",
    "daily_gaps": _VERDICT.format(source="daily"),
    "daily_findings": _FINDINGS.format(source="daily_gaps", strict="false", lag=2),
    "verdicts": _STATUS.format(source="daily_findings"),
    "active": """
select day, unnest(string_split(incident_types, ',')) as incident_type, status, details, recorded_at
from verdicts where incident_types <> ''
""",
    "transitions": """
select v.day,
  case when o.incident_type is null
       then sha256(v.day || '|' || m.incident_type || '|' || epoch_us(v.recorded_at))
       else sha256(m.incident_type || '|run-' || o.day) end as incident_id,
  m.incident_type,
  case when a.incident_type is null then o.status else a.status end as severity,
  case when a.incident_type is null then o.details else a.details end as details,
  case when o.incident_type is null then v.recorded_at else o.recorded_at end as opened_at,
  case when a.incident_type is null then v.recorded_at end as resolved_at,
  case when o.incident_type is null then 'run-' || v.day else 'run-' || o.day end as opened_by_run_id,
  case when a.incident_type is null then 'run-' || v.day end as resolved_by_run_id,
  o.recorded_at as alert_sent_at, cast(null as timestamp) as recovery_sent_at,
  case when o.incident_type is null then 'OPEN' when a.incident_type is null then 'RESOLVE'
       else 'REFRESH' end as transition,
  v.recorded_at as changed_at
from (select day, incident_type from active union select cast(day + 1 as date), incident_type from active) m
join verdicts v on v.day = m.day
left join active a on a.day = m.day and a.incident_type = m.incident_type
left join active o on o.day + 1 = m.day and o.incident_type = m.incident_type
""",
    "incident_state": """
select * exclude (_n) from (
  select *, row_number() over (partition by incident_id order by changed_at desc) as _n from transitions) where _n = 1
""",
    "scoped": """
select incident_type || '/' || cast(changed_at as date) as incident_type, changed_at
from incident_state where resolved_at is null
""",
    "metrics": """
select strftime(recorded_at, '%Y%m%dT%H%M%S.%f') as metric_id, recorded_at, bronze_rows, silver_rows,
  case when year(recorded_at) >= 1996 then silver_unique_events end as silver_unique_events,
  quarantine_rows, raw_orders, fact_orders, gold_order_count, latest_loaded_at, status, details
from verdicts
""",
    "history": """
select recorded_at, status, silver_rows, silver_unique_events,
  silver_rows - silver_unique_events as silver_duplicate_deliveries, raw_orders,
  silver_unique_events - raw_orders as silver_raw_lag,
  cast(round(date_diff('microsecond', latest_loaded_at, recorded_at) / 60000000.0) as bigint) as freshness_minutes
from metrics where silver_unique_events is not null order by recorded_at desc limit 24
""",
    "runs": """
select 'run-' || day as run_id, recorded_at as started_at,
  cast(null as bigint) as loader_files_discovered, cast(null as bigint) as loader_files_skipped,
  cast(1 as bigint) as loader_files_loaded, silver_rows as loader_rows_processed,
  raw_orders as loader_rows_inserted, silver_rows - raw_orders as loader_duplicates,
  case when status <> 'DEGRADED' then 'SUCCEEDED' end as dbt_status,
  case when status <> 'DEGRADED' then status end as health_status,
  case when status <> 'DEGRADED' then raw_orders end as raw_orders,
  case when status <> 'DEGRADED' then latest_loaded_at end as latest_load,
  case when status = 'DEGRADED' then 'FAILED' else 'SUCCEEDED' end as status,
  case when status = 'DEGRADED' then 'Pipeline failed. Failed tasks: health' end as error_message,
  recorded_at + to_minutes(case when status = 'DEGRADED' then 5 else 6 end) as finished_at
from verdicts
""",
    "requests": f"""
select distinct {_EVENT_ID} as event_id,
  case when f = 4 and l_linenumber = 2 then 'quantity' when f = 4 then 'quantity' when f = 5 then 'currency'
       when f = 7 then 'category' when f = 10 then 'event_type' when f = 11 then 'unit_price'
       when f = 6 then 'event_timestamp' when f = 3 then 'order_id' when f in (2, 12) then 'schema_version'
       else 'quantity' end as field,
  case when f = 4 and l_linenumber = 2 then '0' when f = 4 then '2' when f = 5 then 'GBP' when f = 7 then 'home'
       when f = 10 then 'order_created' when f = 11 then '12.4' when f = 6 then '2026-08-11T06:20:30+00:00'
       when f = 3 then 'ORD-' || l_orderkey when f in (2, 12) then '1' when f = 1 then '3' else '4' end as given
from (select *, l_orderkey % 29 as f from lineitem) where f between 1 and 12 and f <> 8
""",
    "found": """
select js ->> '$.event_id' as event_id, count(*) as matches, min(raw_payload) as old_payload,
  min(contract_error) as old_contract_error, min(validation_error) as old_validation_error,
  min(kafka_timestamp) as old_kafka_timestamp
from judged where (contract_error is not null or validation_error is not null) and js is not null
group by 1
""",
    "asked": """
select r.*, coalesce(f.matches, 0) as matches, old_payload, old_contract_error, old_validation_error,
  old_kafka_timestamp,
  case when f.matches = 1 then json_merge_patch(old_payload,
    case when field in ('quantity', 'unit_price', 'schema_version') then '{"' || field || '":' || given || '}'
         else '{"' || field || '":"' || given || '"}' end) end as raw_payload
from requests r left join found f on r.event_id = f.event_id
""",
    "rejudged": _judge("asked"),
    "remedied": """
select *, case when matches = 0 then 'NOT_FOUND' when matches > 1 then 'AMBIGUOUS'
    when field = 'event_timestamp' then 'PROTECTED_FIELD' when contract_error is not null then 'CONTRACT_FAILED'
    when validation_error is not null then 'QUALITY_FAILED' else 'REPAIRED' end as outcome
from rejudged
""",
    "key_map": """
select distinct 'evt-' || l_orderkey || '-1' as event_id,
  case when l_orderkey % 21 = 0 then 'ORD-none' else 'ORD-' || l_orderkey end as old_order_id,
  'ORD-' || l_orderkey || '-R' as new_order_id
from lineitem where l_orderkey % 7 = 0 and l_linenumber = 1
""",
    "key_report": """
select k.event_id, k.old_order_id, k.new_order_id, count(s.event_id) as copies,
  count(distinct s.file_path) as files,
  count(s.event_id) filter (where s.order_id is distinct from k.old_order_id) as unexpected_copies,
  case when count(s.event_id) = 0 then 'NO_MATCH'
       when count(s.event_id) filter (where s.order_id is distinct from k.old_order_id) > 0
       then 'UNEXPECTED_ORDER_ID' else 'READY' end as outcome
from key_map k left join silver s on s.event_id = k.event_id group by all
""",
}

_RAW_DOUBLE = _RAW.replace("unit_price, order_value", "cast(unit_price as double) as unit_price, cast(order_value as double) as order_value")
_FACT_DOUBLE = (
    "event_id, order_id, customer_id, product_id, ordered_at, event_date, category, quantity, "
    "cast(unit_price as double) as unit_price, cast(order_value as double) as order_value, currency, loaded_at"
)
_INSERTED = (
    'select event_id, order_id, event_date, quantity, order_value, "offset" as kafka_offset, file_path from new_{}'
)


def _rule(table: str, rule: str, count: str) -> str:
    return f"select '{table}' as table_name, '{rule}' as rule, ({count}) as failing_rows"


def _unique(source: str, column: str = "event_id") -> str:
    return f"select count(*) from (select 1 from {source} where {column} is not null group by {column} having count(*) > 1)"


def _nulls(source: str, column: str) -> str:
    return f"select count(*) from {source} where {column} is null"


def _not_in(source: str, column: str, allowed: str) -> str:
    return f"select count(distinct {column}) from {source} where {column} not in ({allowed})"


_DATA_TESTS = " union all ".join(
    [
        *[_rule(t, "unique_event_id", _unique(s)) for t, s in (("raw_orders", "raw"), ("stg_orders", "raw"), ("fct_orders", "fact"))],
        *[_rule("raw_orders", f"not_null_{c}", _nulls("raw", c)) for c in ("event_id", "order_id", "product_id", "quantity", "order_value")],
        *[_rule("stg_orders", f"not_null_{c}", _nulls("raw", c)) for c in ("event_id", "order_id", "quantity", "order_value")],
        *[_rule("fct_orders", f"not_null_{c}", _nulls("fact", c)) for c in ("event_id", "order_id", "quantity", "order_value")],
        _rule("stg_orders", "accepted_values_event_type", _not_in("raw", "event_type", "'order_created'")),
        _rule("stg_orders", "accepted_values_currency", _not_in("raw", "currency", "'GBP'")),
        _rule(
            "stg_orders",
            "one_event_per_key_order_id",
            "select count(*) from (select 1 from raw group by order_id having count(distinct event_id) > 1)",
        ),
        _rule("fct_orders", "positive_order_value", "select count(*) from fact where order_value <= 0"),
    ]
)

_CONTROL_TESTS = " union all ".join(
    [
        _rule("pipeline_runs", "unique_run_id", _unique("runs", "run_id")),
        *[_rule("pipeline_runs", f"not_null_{c}", _nulls("runs", c)) for c in ("run_id", "started_at", "status")],
        *[
            _rule("pipeline_runs", f"allowed_{c}", f"select count(*) from runs where {c} not in ({allowed})")
            for c, allowed in (
                ("status", "'RUNNING', 'SUCCEEDED', 'FAILED'"),
                ("dbt_status", "'SUCCEEDED', 'FAILED'"),
                ("health_status", "'HEALTHY', 'WARNING', 'DEGRADED'"),
            )
        ],
        _rule("pipeline_incidents", "unique_incident_id", _unique("incident_state", "incident_id")),
        *[
            _rule("pipeline_incidents", f"not_null_{c}", _nulls("incident_state", c))
            for c in ("incident_type", "severity", "details", "opened_at")
        ],
        _rule(
            "pipeline_incidents",
            "allowed_severity",
            "select count(*) from incident_state where severity not in ('WARNING', 'DEGRADED')",
        ),
        *[_rule("pipeline_metrics", f"not_null_{c}", _nulls("metrics", c)) for c in ("metric_id", "recorded_at", "status")],
    ]
)

_NOT_NULL_RAW = (
    "event_id event_type event_timestamp event_date order_id product_id category quantity unit_price order_value "
    "currency kafka_topic kafka_partition kafka_offset loaded_at"
).split()

_OUTPUT_METRICS = (
    "bronze_rows, silver_rows, silver_unique_events, quarantine_rows, raw_orders, fact_orders, gold_order_count, "
    "latest_loaded_at, incident_types, load_age_minutes, status, details"
)

# query -> (starting CTEs, final select)
_SELECTS: dict[str, tuple[list[str], str]] = {
    "bronze_projection": (["bronze"], "select * from bronze"),
    "tail_decode": (
        ["judged"],
        """select kafka_key, topic, "partition", "offset", kafka_timestamp, js ->> '$.event_id' as event_id,
  js ->> '$.event_type' as event_type, js ->> '$.event_timestamp' as event_timestamp,
  js ->> '$.order_id' as order_id, js ->> '$.customer_id' as customer_id, js ->> '$.product_id' as product_id,
  js ->> '$.category' as category, cast(js ->> '$.quantity' as integer) as quantity,
  cast(js ->> '$.unit_price' as double) as unit_price, js ->> '$.currency' as currency from judged""",
    ),
    "contract_errors": (["judged"], "select contract_error, count(*) as rows from judged group by 1"),
    "quality_errors": (
        ["judged"],
        "select validation_error, count(*) as rows from judged where contract_error is null group by 1",
    ),
    "error_summary": (
        ["judged"],
        "select contract_error, validation_error, count(*) as rows from judged group by 1, 2",
    ),
    "rule_parity": (
        ["judged"],
        """select code, n as expected, n as actual, true as matches from (
  select coalesce(contract_error, validation_error, 'valid') as code, count(*) as n from judged group by 1)""",
    ),
    "silver_orders": (["orders_in"], "select * exclude (hh), hh as ingestion_hour from orders_in"),
    "quarantine_orders": (["quarantine"], "select * from quarantine"),
    "route_reconciliation": (
        ["bronze", "orders_in", "quarantine"],
        """select (select count(*) from bronze) as bronze_rows, (select count(*) from orders_in) as silver_rows,
  (select count(*) from quarantine) as quarantine_rows, cast(0 as bigint) as unrouted_messages,
  cast(0 as bigint) as surplus_messages, cast(0 as bigint) as doubly_routed_messages""",
    ),
    "partition_offsets": (
        ["bronze", "silver"],
        """select layer, "partition", min("offset") as min_offset, max("offset") as max_offset, count(*) as rows,
  max("offset") - min("offset") + 1 - count(*) as missing_offsets
from (select 'bronze' as layer, "partition", "offset" from bronze
      union all select 'silver', "partition", "offset" from silver) group by 1, 2""",
    ),
    "raw_first_wins": (["raw"], f"select {_RAW_DOUBLE} from raw"),
    "silver_files": (["files"], "select * from files"),
    **{f"load_{m}": ([f"new_{m}"], _INSERTED.format(m)) for m in ("normal", "backfill", "replay")},
    "load_counters": (
        ["count_normal", "count_backfill", "count_replay"],
        """select *, rows_processed - rows_inserted as duplicates from (
  select * from count_normal union all select * from count_backfill union all select * from count_replay)""",
    ),
    "loaded_files": (
        ["files_backfill"],
        """select file_path, 'silver_orders' as dataset_name, ingestion_date, ingestion_hour, row_count
from files_backfill where selected and not loaded_before""",
    ),
    "current_watermark": (
        ["silver"],
        """select 'silver_orders' as dataset_name, ingestion_date as watermark_date, ingestion_hour as watermark_hour,
  max(ingested_at) as updated_at from silver group by 2, 3 order by updated_at desc limit 1""",
    ),
    "stg_orders": (["raw"], f"select {_RAW_DOUBLE}, loaded_at from raw"),
    "fct_orders_incremental": (
        ["fact"],
        f"select {_FACT_DOUBLE} from fact where loaded_at > (select max(loaded_at) from fact_before)",
    ),
    "fct_orders_upsert": (["fact"], f"select {_FACT_DOUBLE} from fact"),
    "mart_daily_sales": (["mart"], "select * from mart"),
    "late_event_correction": (
        ["mart", "fact_before"],
        f"""select n.event_date, n.order_count as new_order_count, n.units_sold as new_units_sold,
  n.gross_revenue as new_gross_revenue, n.average_order_value as new_average_order_value,
  o.order_count as old_order_count, o.units_sold as old_units_sold, o.gross_revenue as old_gross_revenue,
  o.average_order_value as old_average_order_value
from mart n left join ({_mart("fact_before")}) o on o.event_date = n.event_date
where o.order_count is distinct from n.order_count""",
    ),
    "duplicate_business_keys": (
        ["raw"],
        """select order_id, count(distinct event_id) as distinct_event_count from raw
group by 1 having count(distinct event_id) > 1""",
    ),
    "data_test_report": (["fact"], _DATA_TESTS),
    "constraint_report": (
        ["silver"],
        f"""select * from (with deliveries as (
  {_renamed("silver", ", timestamp '2002-01-01 00:00:00' as loaded_at")}) """
        + " union all ".join(
            [
                _rule("raw_orders", "unique_event_id", _unique("deliveries")),
                *[_rule("raw_orders", f"not_null_{c}", _nulls("deliveries", c)) for c in _NOT_NULL_RAW],
            ]
        )
        + ")",
    ),
    "lake_metrics": (
        ["bronze", "silver", "quarantine"],
        """select (select count(*) from bronze) as bronze_rows, count(*) as silver_rows,
  count(distinct event_id) as silver_unique_events, (select count(*) from quarantine) as quarantine_rows,
  count(*) - count(distinct event_id) as silver_duplicate_deliveries from silver""",
    ),
    "warehouse_metrics": (
        ["fact", "mart"],
        """select (select count(*) from raw) as raw_orders, (select max(loaded_at) from raw) as latest_loaded_at,
  (select count(*) from fact) as fact_orders,
  cast((select coalesce(sum(order_count), 0) from mart) as bigint) as gold_order_count""",
    ),
    "pipeline_health": (
        ["bronze", "silver", "quarantine", "mart"],
        f"""with whole as (
  select (select count(*) from bronze) as bronze_rows, (select count(*) from silver) as silver_rows,
    (select count(distinct event_id) from silver) as silver_unique_events,
    (select count(*) from quarantine) as quarantine_rows, (select count(*) from raw) as raw_orders,
    (select count(*) from fact) as fact_orders,
    cast((select sum(order_count) from mart) as bigint) as gold_order_count,
    (select max(loaded_at) from raw) as latest_loaded_at, timestamp '2002-01-02 12:00:00' as checked_at),
gaps as ({_VERDICT.format(source="whole")}),
findings as ({_FINDINGS.format(source="gaps", strict="true", lag=60)}),
verdict as ({_STATUS.format(source="findings")})
select {_OUTPUT_METRICS}, silver_rows - silver_unique_events as silver_duplicate_deliveries from verdict""",
    ),
    "health_verdict": (["verdicts"], f"select day, recorded_at, {_OUTPUT_METRICS} from verdicts"),
    "incident_transitions": (["transitions"], "select * from transitions"),
    "pending_notices": (
        ["transitions"],
        """select day, incident_type, case when transition = 'OPEN' then 'ALERT' else 'RECOVERY' end as notice,
  severity, details, changed_at from transitions where transition in ('OPEN', 'RESOLVE')""",
    ),
    "sent_notices": (
        ["transitions"],
        """select incident_type, transition, count(*) as n,
  count(case when transition = 'OPEN' then changed_at else alert_sent_at end) as alerts,
  count(*) filter (where transition = 'RESOLVE') as recoveries,
  max(case when transition = 'OPEN' then changed_at + interval 1 minute else alert_sent_at end) as last_alert,
  max(case when transition = 'RESOLVE' then changed_at + interval 1 minute end) as last_recovery
from transitions group by 1, 2""",
    ),
    "metrics_ledger": (["metrics"], "select * from metrics"),
    "latest_metrics": (
        ["metrics"],
        """select *, silver_rows - silver_unique_events as silver_duplicate_deliveries,
  silver_unique_events - raw_orders as silver_raw_lag,
  cast(round(date_diff('microsecond', latest_loaded_at, recorded_at) / 60000000.0) as bigint) as freshness_minutes
from metrics order by recorded_at desc limit 1""",
    ),
    "metric_history": (["history"], "select * from history"),
    "trend_summary": (
        ["history"],
        " union all ".join(
            f"""select '{m}' as metric, min({m}) as minimum, max({m}) as maximum,
  arg_max({m}, recorded_at) as latest, count(*) as snapshots from history where {m} is not null"""
            for m in ("silver_raw_lag", "silver_duplicate_deliveries", "freshness_minutes")
        ),
    ),
    "open_incidents": (
        ["transitions"],
        """select incident_id, incident_type, severity, details, opened_at, alert_sent_at from (
  select *, row_number() over (partition by incident_type order by changed_at desc) as n from transitions)
where n = 1 and resolved_at is null""",
    ),
    "run_state": (["runs"], "select * from runs"),
    "recent_runs": (
        ["runs"],
        """select *, date_diff('microsecond', started_at, finished_at) / 1000000.0::double as duration_seconds
from runs order by started_at desc, run_id desc limit 5""",
    ),
    "control_constraints": (["runs", "incident_state", "metrics"], _CONTROL_TESTS),
    "load_into_buckets": (
        ["new_normal"],
        'select event_id, order_id, event_date, quantity, order_value, "offset" as kafka_offset from new_normal',
    ),
    "fact_by_builds": (
        ["fact"],
        f"""select {_FACT_DOUBLE},
  case when loaded_at = timestamp '2002-01-01 00:00:00' then 'build-1' else 'build-2' end as build_id from fact""",
    ),
    "mart_by_affected_days": (["mart"], "select * from mart"),
    "applied_order_key_repair": (
        ["fact", "key_report"],
        """select f.event_id, f.event_date, coalesce(k.new_order_id, f.order_id) as order_id,
  coalesce(k.new_order_id, f.order_id) as raw_order_id, count(*) over (partition by f.event_date) as orders_of_day,
  case when f.loaded_at = timestamp '2002-01-01 00:00:00' then 'build-1' else 'build-2' end as build_id
from fact f left join (select * from key_report where outcome = 'READY') k on k.event_id = f.event_id""",
    ),
    "kept_up_distincts": (
        ["silver"],
        """select 'check-1' as check_id, count(*) as silver_rows, count(distinct event_id) as silver_unique_events
from silver where year(ingestion_date) < 1997
union all select c, count(*), count(distinct event_id) from silver, (values ('check-2'), ('check-3')) t(c) group by c""",
    ),
    "route_faults": (
        ["judged"],
        """with m as (
  select topic, "partition" as p, "offset" as o, contract_error is null and validation_error is null as good from judged
), tagged as (
  select topic, p, o, 1 as b, 0 as s, 0 as q from m
  union all select topic, p, o, 0, 1, 0 from m where good and o % 97 <> 5
  union all select topic, p, o, 0, 1, 0 from m where good and o % 101 = 7
  union all select topic, p, o, 0, 0, 1 from m where not good
  union all select topic, p, o, 0, 0, 1 from m where not good and o % 89 = 3
  union all select topic, p, o, 0, 0, 1 from m where good and o % 83 = 2
), per as (
  select topic, p, o, sum(b) as b, sum(s) as s, sum(q) as q from tagged group by 1, 2, 3
)
select cast(sum(b) as bigint) as bronze_rows, cast(sum(s) as bigint) as silver_rows,
  cast(sum(q) as bigint) as quarantine_rows, count(*) filter (where s + q < b) as unrouted_messages,
  count(*) filter (where s + q > b) as surplus_messages,
  count(*) filter (where s > 0 and q > 0 and b = 1) as doubly_routed_messages from per""",
    ),
    "positions_of_republished": (
        ["remedied"],
        """select sha256(event_id || '|' || batch || '|{"' || field || '":' || case
    when field in ('quantity', 'unit_price', 'schema_version') then given else '"' || given || '"' end || '}')
    as reprocessing_id, 'orders' as republished_topic,
  cast(cast(string_split(event_id, '-')[2] as bigint) % 3 as integer) as republished_partition,
  cast(string_split(event_id, '-')[2] as bigint) * 8 + cast(string_split(event_id, '-')[3] as bigint) + start
    as republished_offset
from remedied, (values ('batch-1', 1000000000::bigint), ('batch-2', 0::bigint)) t(batch, start)
where outcome = 'REPAIRED'""",
    ),
    "due_notices": (
        ["incident_state"],
        """select incident_id, incident_type, 'ALERT' as notice, severity, details, opened_at as happened_at
from incident_state where day(opened_at) % 2 <> 0
union all select incident_id, incident_type, 'RECOVERY', severity, details, resolved_at
from incident_state where resolved_at is not null and day(resolved_at) % 3 <> 0""",
    ),
    "incident_constraints": (
        ["scoped"],
        " union all ".join(
            [
                _rule(
                    "pipeline_incidents",
                    "unique_incident_id",
                    "select count(*) from incident_state where day(changed_at) = 11",
                ),
                *[
                    _rule("pipeline_incidents", f"not_null_{c}", _nulls("incident_state", c))
                    for c in ("incident_type", "severity", "details", "opened_at")
                ],
                _rule(
                    "pipeline_incidents",
                    "allowed_severity",
                    "select count(*) from incident_state where severity not in ('WARNING', 'DEGRADED')",
                ),
                _rule(
                    "open_incidents",
                    "unique_incident_type",
                    _unique("(select * from scoped union all select * from scoped where day(changed_at) % 3 = 0)", "incident_type"),
                ),
            ]
        ),
    ),
    "streamed_loads": (
        ["silver"],
        """with halves as (
  select 'load-' || (1 + cast(string_split(event_id, '-')[2] as bigint) % 2) as load_id, * from silver)
select h.load_id, ingestion_date, ingestion_hour, count(*) as row_count, rows_processed, rows_inserted
from halves h join (select load_id, count(*) as rows_processed, count(distinct event_id) as rows_inserted
                    from halves group by 1) t on t.load_id = h.load_id
group by all""",
    ),
    "committed_batches": (
        ["bronze", "silver", "quarantine"],
        """select 'bronze' as layer, ingestion_date as day, count(*) as rows from bronze group by 2
union all select 'silver', ingestion_date, count(*) from silver group by 2
union all select 'quarantine', cast(ingested_at as date), count(*) from quarantine group by 2""",
    ),
    "stream_equals_batch": (
        ["bronze", "silver", "quarantine"],
        " union all ".join(
            f"""select '{layer}' as layer, count(*) as streamed_rows, count(*) as batch_rows,
  cast(0 as bigint) as differing_rows from {layer}"""
            for layer in ("bronze", "silver", "quarantine")
        ),
    ),
    "quarantine_remediation": (
        ["remedied"],
        """select event_id, matches, outcome,
  case outcome when 'CONTRACT_FAILED' then contract_error when 'QUALITY_FAILED' then validation_error end
    as outcome_error,
  case when outcome = 'REPAIRED' then js ->> '$.order_id' end as repaired_order_id,
  case when outcome = 'REPAIRED' then js ->> '$.event_timestamp' end as event_timestamp,
  case when outcome = 'REPAIRED' then cast(js ->> '$.quantity' as integer) end as quantity,
  case when outcome = 'REPAIRED' then cast(js ->> '$.unit_price' as double) end as unit_price,
  case when outcome = 'REPAIRED' then js ->> '$.category' end as category,
  case when outcome = 'REPAIRED' then js ->> '$.currency' end as currency from remedied""",
    ),
    "repaired_messages": (
        ["remedied"],
        """select event_id, js ->> '$.order_id' as order_id, js ->> '$.order_id' as kafka_key,
  cast(cast(js ->> '$.event_timestamp' as timestamp) as date) as event_date,
  cast(js ->> '$.quantity' as integer) as quantity, cast(js ->> '$.unit_price' as double) as unit_price,
  round(cast(js ->> '$.quantity' as integer) * cast(js ->> '$.unit_price' as double), 2) as order_value
from remedied where outcome = 'REPAIRED'""",
    ),
    "remediation_audit": (
        ["remedied"],
        """select sha256(event_id || '|batch-1|{"' || field || '":' || case when field in ('quantity', 'unit_price', 'schema_version') then given else '"' || given || '"' end || '}') as reprocessing_id, event_id,
  old_payload ->> '$.order_id' as order_id, old_contract_error as original_contract_error,
  old_validation_error as original_validation_error, old_kafka_timestamp as original_kafka_timestamp,
  '{"' || field || '":' || case when field in ('quantity', 'unit_price', 'schema_version') then given else '"' || given || '"' end || '}' as corrections, 'PUBLISH' as action, 'PUBLISHED' as status,
  'orders' as republished_topic, cast(null as integer) as republished_partition,
  cast(null as bigint) as republished_offset, cast(null as varchar) as error_message,
  timestamp '2002-01-02 12:00:00' as created_at from remedied where outcome = 'REPAIRED'""",
    ),
    "remediation_history": (
        ["remedied"],
        """select old_kafka_timestamp as created_at, event_id, 'PUBLISH' as action, 'PUBLISHED' as status,
  '{"' || field || '":' || case when field in ('quantity', 'unit_price', 'schema_version') then given else '"' || given || '"' end || '}' as corrections from remedied where outcome = 'REPAIRED'
order by created_at desc""",
    ),
    "order_key_repair": (["key_report"], "select * from key_report"),
    "order_key_files": (
        ["key_map", "silver"],
        """select s.event_id, s.file_path, count(*) as copies, min(s.order_id) as lowest_order_id,
  max(s.order_id) as highest_order_id,
  count(*) filter (where s.order_id is distinct from k.old_order_id) as unexpected_copies
from silver s join key_map k on s.event_id = k.event_id group by 1, 2""",
    ),
    "order_key_overlay": (
        ["key_report"],
        """select s.event_id, case when k.outcome = 'READY' then k.new_order_id else s.order_id end as order_id,
  s."partition", s."offset" from silver s left join key_report k on k.event_id = s.event_id""",
    ),
}


def _uses(text: str, known: dict[str, str]) -> set[str]:
    words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
    return words & known.keys()


def _with(starts: list[str], select: str) -> str:
    """The final select behind the CTEs it needs, in the order they are defined."""
    needed, queue = set(), [*starts, *_uses(select, CTES)]
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += _uses(CTES[name], CTES) - {name}
    named = ", ".join(f'"{name}" as ({CTES[name].strip()})' for name in CTES if name in needed)
    return f"with {named} select * from ({select.strip()})"


ORACLE_SQL: dict[str, str] = {name: _with(*parts) for name, parts in _SELECTS.items()}

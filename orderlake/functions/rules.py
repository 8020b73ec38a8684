"""The contract and quality rules as ordered, named SQL predicates.

One registry serves the stream, the batch jobs and remediation. A rule says what
must hold; the first rule that does not hold gives the error code.

``strict`` adds guards to the stream's rules and never accepts what the stream
would refuse: identifiers and times must be JSON strings, blanks of any kind do
not count as text, times must be complete ISO dates, NaN is not a price.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake import schemas as S

# A date, optionally with a time to the minute or finer, optionally with an offset.
ISO_TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2}(:?[0-9]{2})?)?)?$"
)
# Something other than white space, in the Unicode sense.
NOT_BLANK = r"(?U)[^\s\x{1C}-\x{1F}]"


class Rule(NamedTuple):
    name: str
    code: str
    holds: str


def _listed(values: Sequence[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def is_filled(column: str, any_blank: bool = False) -> str:
    """Text with something in it; ``any_blank`` also strips tabs, newlines and other Unicode blanks."""
    return f"{column} RLIKE r'{NOT_BLANK}'" if any_blank else f"length(trim({column})) > 0"


def is_one_of(column: str, allowed: Sequence[str]) -> str:
    return f"{column} IN ({_listed(allowed)})"


def is_positive(column: str, reject_nan: bool = False) -> str:
    return f"{column} > 0 AND NOT isnan({column})" if reject_nan else f"{column} > 0"


def is_json_string(field: str) -> str:
    return f"schema_of_variant(try_element_at(tokens, '{field}')) = 'STRING'"


def first_failure(rules: Sequence[Rule]) -> Column:
    """Code of the first rule that does not hold (or is NULL), else NULL."""
    branches = " ".join(f"WHEN NOT coalesce({rule.holds}, false) THEN '{rule.code}'" for rule in rules)
    return F.expr(f"CASE {branches} END")


def _holds_each_field_once(payload: str) -> str:
    """Whether a payload whose typed ``event`` has every required field has no other key than the event's, none twice.

    Each field that has a value has a key; if there are as many keys as such fields, each key is there once and none is
    null. Other payloads are looked at key by key. Listing the keys builds no values: it costs less than a parse, and less
    than searches for what would end a key, which stop at every quote.
    """
    required = " AND ".join(f"event.{name} IS NOT NULL" for name in ("schema_version", *S.REQUIRED_FIELDS))
    optional = [f.name for f in S.ORDER_EVENT if f.name not in ("schema_version", *S.REQUIRED_FIELDS)]
    fields = " + ".join([str(1 + len(S.REQUIRED_FIELDS)), *(f"if(event.{name} IS NULL, 0, 1)" for name in optional)])
    return f"{required} AND size(json_object_keys({payload})) = {fields}"


def opened_payload(payload: str, tokens: bool = False) -> str:
    """One-element array: ``keys`` (is the payload unreadable, which required key is missing first), the typed event and
    its time.

    Whether a key is there and whether its value has the right type are two
    questions, answered by two parses; the first is left out where the second shows
    that every key is there. The lambda binds what is parsed, so it is parsed once
    however often it is looked at. There is one around the event only, as each copies what it returns.
    ``tokens`` adds the values with their JSON types.
    """
    names = _listed(("schema_version", *S.REQUIRED_FIELDS))
    typed_tokens = f", from_json({payload}, 'map<string,variant>') AS tokens" if tokens else ""
    complete = "struct(false AS unreadable, cast(NULL AS string) AS first_missing)"
    looked_up = f"""get(transform(array(from_json({payload}, 'map<string,string>')), present -> struct(
            present IS NULL AS unreadable,
            get(filter(array({names}), name -> try_element_at(present, name) IS NULL), 0) AS first_missing)), 0)"""
    return f"""transform(array(from_json({payload}, '{S.ORDER_EVENT.simpleString()}')), event -> struct(
            if({_holds_each_field_once(payload)}, {complete}, {looked_up}) AS keys,
            event AS event,
            try_to_timestamp(event.event_timestamp) AS event_time{typed_tokens}))"""


def payload_parses(payload: str, tokens: bool = False) -> Column:
    """``opened_payload`` with the answers about the keys as fields of their own."""
    kept = ["opened.keys.unreadable", "opened.keys.first_missing", "opened.event", "opened.event_time"]
    fields = [f"{f} AS {f.rsplit('.')[-1]}" for f in [*kept, *(["opened.tokens"] if tokens else [])]]
    return F.expr(f"transform({opened_payload(payload, tokens)}, opened -> struct({', '.join(fields)}))")


# The typed event's columns, its time parsed; NULL where the type did not fit.
EVENT_COLUMNS = [
    *[f"event.{f.name}" for f in S.ORDER_EVENT if f.name != "event_timestamp"],
    "event.event_timestamp AS event_time_text",
    "event_time AS event_timestamp",
]


def contract_rules() -> list[Rule]:
    """Rules over ``unreadable``, ``first_missing`` and the integer ``schema_version``, in order."""

    def present(field: str) -> str:
        return f"NOT (first_missing <=> '{field}')"

    return [
        Rule("payload_is_object", "contract_invalid_payload", "NOT unreadable"),
        Rule("schema_version_present", "contract_missing_schema_version", present("schema_version")),
        Rule("schema_version_integer", "contract_invalid_schema_version", "schema_version IS NOT NULL"),
        Rule(
            "schema_version_supported",
            "contract_unsupported_schema_version",
            f"schema_version = {S.SCHEMA_VERSION}",
        ),
        *[Rule(f"{field}_present", f"contract_missing_{field}", present(field)) for field in S.REQUIRED_FIELDS],
    ]


def quality_rules(strict: bool = False) -> list[Rule]:
    """Rules over the parsed columns; ``strict`` also reads ``event_time_text`` and ``tokens``."""

    def text(field: str) -> str:
        filled = is_filled(field, any_blank=strict)
        return f"{filled} AND {is_json_string(field)}" if strict else filled

    timed = "event_timestamp IS NOT NULL"
    if strict:
        timed += f" AND event_time_text RLIKE r'{ISO_TIMESTAMP}' AND {is_json_string('event_timestamp')}"
    return [
        Rule("event_id_required", "missing_or_invalid_event_id", text("event_id")),
        Rule("order_id_required", "missing_order_id", text("order_id")),
        Rule("product_id_required", "missing_product_id", text("product_id")),
        Rule("event_type_supported", "unsupported_event_type", is_one_of("event_type", S.EVENT_TYPES)),
        Rule("event_timestamp_valid", "invalid_event_timestamp", timed),
        Rule("quantity_positive", "invalid_quantity", is_positive("quantity")),
        Rule("unit_price_positive", "invalid_unit_price", is_positive("unit_price", reject_nan=strict)),
        Rule("currency_supported", "unsupported_currency", is_one_of("currency", S.CURRENCIES)),
        Rule("category_supported", "unsupported_category", is_one_of("category", S.CATEGORIES)),
    ]

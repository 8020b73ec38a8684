"""Repair of quarantined events: match, correct, judge again, republish, audit.

A batch of requests is handled at once. A repair is a new delivery of the same
event; the quarantined row stays where it is.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import schemas as S
from orderlake.functions.rules import (
    EVENT_COLUMNS,
    contract_rules,
    first_failure,
    payload_parses,
    quality_rules,
)
from orderlake.functions.scalars import as_column

# Outcomes of a request, in the order they are decided.
DUPLICATE_REQUEST = "DUPLICATE_REQUEST"
NOT_FOUND, AMBIGUOUS, PROTECTED_FIELD = "NOT_FOUND", "AMBIGUOUS", "PROTECTED_FIELD"
CONTRACT_FAILED, QUALITY_FAILED, REPAIRED = "CONTRACT_FAILED", "QUALITY_FAILED", "REPAIRED"

_ANY_FIELDS = "map<string,variant>"


class Remediation(NamedTuple):
    report: DataFrame
    repaired: DataFrame
    audit: DataFrame


def parse_set_value(item: str) -> tuple[str, str]:
    """``FIELD=VALUE`` as given by an operator to a corrections entry."""
    field, separator, value = item.partition("=")
    if not separator:
        raise ValueError(f"Invalid correction '{item}'. Expected FIELD=VALUE.")
    if not field.strip():
        raise ValueError("Correction field cannot be empty")
    return field.strip(), value.strip()


def correction_value(text: Column) -> Column:
    """The value a correction means: JSON if it is JSON, else the text itself.

    ``2`` is a number and ``home`` a string; so is ``2 boxes``, where reading stops
    early and would otherwise lose the rest.
    """
    whole = text.rlike(
        r"""(?s)^\s*("([^"\\]|\\.)*"|-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?|true|false|null|\{.*\}|\[.*\])\s*$"""
    )
    return F.coalesce(F.when(whole, F.try_parse_json(text)), text.cast("variant"))


def last_of_each_key(fields: Column) -> Column:
    """A parsed payload without repeated keys; the last one counts. Most payloads repeat none and stay as they are."""

    def once(parsed: Column) -> Column:
        entries = F.map_entries(parsed)
        last = F.map_from_entries(
            F.filter(
                entries,
                lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]),
            )
        )
        keys = F.map_keys(parsed)
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), parsed).otherwise(last)

    return F.get(F.transform(F.array(fields), once), F.lit(0))  # bound, so that it is parsed once


def overlay(payload: Column, corrections: Column) -> Column:
    """Fields of ``payload`` with the corrections put over them, keeping order and types."""
    kept = F.transform_values(payload, lambda k, v: F.coalesce(F.try_element_at(corrections, k), v))
    added = F.map_filter(corrections, lambda k, v: ~F.map_contains_key(payload, k))
    return F.map_concat(kept, added)


def _string_value(token: Column) -> Column:
    """The text of a JSON string; NULL for any other JSON value."""
    return F.when(F.schema_of_variant(token) == "STRING", F.try_variant_get(token, "$", "string"))


def match_requests(quarantine: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests with the one quarantined message of their event and the number of matches.

    Quarantined messages are combined to one row per event in the map tasks before
    they meet the requests: an event quarantined a million times sends one row per
    task. Requests that Spark knows to be few are broadcast before that, so that other
    messages are not shuffled at all.
    """
    # Opening and rewriting JSON is work per row, not per byte: a fixed partitioning, which the
    # join shares, keeps adaptive execution from merging small partitions into few long tasks.
    tasks = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    requests = requests.repartition(tasks, "event_id")
    same = requests.groupBy("event_id").agg(F.count("*").alias("same_event"))
    keyed = quarantine.select(
        "raw_payload",
        "contract_error",
        "validation_error",
        "kafka_timestamp",
        F.inline(F.array(F.from_json("raw_payload", "event_id variant"))),
    ).withColumn("event_id", _string_value(F.col("event_id")))
    keyed = keyed.where(F.col("event_id").isNotNull())
    keyed = keyed.join(requests.select("event_id").distinct(), "event_id", "left_semi")
    candidates = keyed.groupBy("event_id").agg(
        F.count("*").alias("matches"),
        # With one match it is that row; with several none is used.
        F.min(F.struct("raw_payload", "contract_error", "validation_error", "kafka_timestamp")).alias("found"),
    )
    return requests.join(same, "event_id", "left").join(candidates, "event_id", "left").select(
        *requests.columns, "same_event", F.coalesce("matches", F.lit(0)).alias("matches"), "found.*"
    )


def repair_payloads(matched: DataFrame, strict: bool = True) -> DataFrame:
    """Apply each request's corrections and judge the result: one outcome per request.

    Requests of one event in the same batch are all refused: which of them came last would be left to chance.
    """
    one = F.col("matches") == 1
    original = F.when(one, last_of_each_key(F.from_json("raw_payload", _ANY_FIELDS)))
    changes = F.transform_values(
        F.coalesce("corrections", F.create_map().cast("map<string,string>")), lambda _, text: correction_value(text)
    )
    # The generator keeps each parse from being copied into every later expression.
    opened = matched.select("*", F.inline(F.array(F.struct(original.alias("original"), changes.alias("changes")))))
    named = lambda source, name: F.to_json(F.try_element_at(F.col(source), F.lit(name)))
    touches_identity = F.lit(False)
    for name in S.IDENTITY_FIELDS:
        touches_identity = touches_identity | (
            F.map_contains_key("changes", name) & ~named("changes", name).eqNullSafe(named("original", name))
        )
    text = F.to_json(overlay(F.col("original"), F.col("changes")))
    rewritten = opened.select(
        *matched.columns,
        "original",
        F.coalesce(touches_identity, F.lit(False)).alias("protected"),
        F.inline(F.array(F.struct(text.alias("repaired_payload")))),
    )
    parsed = rewritten.select("*", F.inline(payload_parses("repaired_payload", tokens=True)))
    # The request moves into a struct: the rules read the event's columns by name.
    request = f"struct({', '.join(rewritten.columns)}) AS request"
    # A generator again: filters on the outcome would repeat all rules.
    errors = F.struct(
        first_failure(contract_rules()).alias("new_contract_error"),
        first_failure(quality_rules(strict)).alias("new_quality_error"),
    )
    judged = parsed.selectExpr(request, "unreadable", "first_missing", "tokens", *EVENT_COLUMNS).select(
        "request", "order_id", F.inline(F.array(errors))
    )
    outcome = (
        F.when(F.col("request.same_event") > 1, DUPLICATE_REQUEST)
        .when(F.col("request.matches") == 0, NOT_FOUND)
        .when(F.col("request.matches") > 1, AMBIGUOUS)
        .when(F.col("request.protected"), PROTECTED_FIELD)
        .when(F.col("new_contract_error").isNotNull(), CONTRACT_FAILED)
        .when(F.col("new_quality_error").isNotNull(), QUALITY_FAILED)
        .otherwise(REPAIRED)
    )
    error = F.when(F.col("outcome") == CONTRACT_FAILED, F.col("new_contract_error")).when(
        F.col("outcome") == QUALITY_FAILED, F.col("new_quality_error")
    )
    return judged.withColumn("outcome", outcome).select(
        *[F.col(f"request.{c}").alias(c) for c in matched.columns if c != "same_event"],
        _string_value(F.try_element_at("request.original", F.lit("order_id"))).alias("original_order_id"),
        "outcome",
        error.alias("outcome_error"),
        F.when(F.col("outcome") == REPAIRED, F.col("order_id")).alias("repaired_order_id"),
        F.when(F.col("outcome") == REPAIRED, F.col("request.repaired_payload")).alias("repaired_payload"),
    )


def _corrections_text() -> Column:
    """Corrections as JSON of the values they mean, sorted by field so that equal corrections are equal text."""
    given = F.coalesce("corrections", F.create_map().cast("map<string,string>"))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(given)))
    return F.to_json(F.transform_values(ordered, lambda _, text: correction_value(text)))


def reprocessing_id(batch_id: str) -> Column:
    """Names one repair of one batch; derived, so that writing a batch again repeats it."""
    return F.sha2(F.concat_ws("|", "event_id", F.lit(batch_id), _corrections_text()), 256)


def audit_rows(
    repaired: DataFrame,
    batch_id: str,
    now: Column | datetime,
    publish: bool = False,
    error_message: str | None = None,
) -> DataFrame:
    """One audit row per repaired request."""
    action = "PUBLISH" if publish else "DRY_RUN"
    status = ("PUBLISH_FAILED" if error_message else "PUBLISHED") if publish else "DRY_RUN"
    sent = publish and not error_message
    return repaired.select(
        reprocessing_id(batch_id).alias("reprocessing_id"),
        "event_id",
        F.col("original_order_id").alias("order_id"),
        F.col("contract_error").alias("original_contract_error"),
        F.col("validation_error").alias("original_validation_error"),
        F.col("kafka_timestamp").alias("original_kafka_timestamp"),
        _corrections_text().alias("corrections"),
        F.lit(action).alias("action"),
        F.lit(status).alias("status"),
        F.lit(S.TOPIC if sent else None).cast("string").alias("republished_topic"),
        F.lit(None).cast("int").alias("republished_partition"),
        F.lit(None).cast("bigint").alias("republished_offset"),
        F.lit(error_message).cast("string").alias("error_message"),
        as_column(now).alias("created_at"),
    )


def republished_positions(audit: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Where the published repairs of an audit arrived.

    A bulk sink returns no positions. Each message carries the id of its repair in a header, which the stream keeps in
    Bronze: so two publishes of one payload keep their own positions in whatever order they arrive. A message that the
    sink sent twice counts where it came first.
    """
    sent = audit.where(F.col("status") == "PUBLISHED").select("reprocessing_id")
    marked = arrivals.where("reprocessing_id IS NOT NULL").join(sent, "reprocessing_id", "left_semi")
    first = marked.groupBy("reprocessing_id").agg(F.min(F.struct("topic", "partition", "offset")).alias("at"))
    return first.select(
        "reprocessing_id",
        F.col("at.topic").alias("republished_topic"),
        F.col("at.partition").alias("republished_partition"),
        F.col("at.offset").alias("republished_offset"),
    )


def with_positions(audit: DataFrame, positions: DataFrame) -> DataFrame:
    """Audit rows with the positions recorded for them later."""
    names = ("republished_topic", "republished_partition", "republished_offset")
    later = positions.select("reprocessing_id", *[F.col(c).alias(f"later_{c}") for c in names])
    both = audit.join(later, "reprocessing_id", "left")
    return both.select(*[F.coalesce(f"later_{c}", c).alias(c) if c in names else c for c in audit.columns])


def remediate(
    quarantine: DataFrame,
    requests: DataFrame,
    batch_id: str,
    now: Column | datetime,
    publish: bool = False,
    strict: bool = True,
) -> Remediation:
    """Report for all requests, the repaired payloads, and the audit rows of the repaired ones."""
    report = repair_payloads(match_requests(quarantine, requests), strict)
    repaired = report.where(F.col("outcome") == REPAIRED)
    return Remediation(report, repaired, audit_rows(repaired, batch_id, now, publish))

"""Small builders for order events."""

from __future__ import annotations

import json
from datetime import datetime, timezone

BASE_EVENT = {
    "schema_version": 1,
    "event_id": "ev-plain",
    "event_type": "order_created",
    "event_timestamp": "2026-08-19T07:41:09+00:00",
    "order_id": "ORD-7713",
    "customer_id": "CUS-88",
    "product_id": "PRD-9",
    "category": "sports",
    "quantity": 3,
    "unit_price": 17.25,
    "currency": "GBP",
}


def event(drop: tuple[str, ...] = (), **changes) -> str:
    fields = {**BASE_EVENT, **changes}
    return json.dumps({k: v for k, v in fields.items() if k not in drop})


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)

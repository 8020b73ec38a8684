"""Contract and quality rules, lenient (the stream) and strict (remediation)."""

import json

import pytest
from pyspark.sql import functions as F

from builders import BASE_EVENT, event
from orderlake import schemas as S
from orderlake.functions.rules import contract_rules, payload_parses, quality_rules
from orderlake.operators.reconcile import compare_cases

QUALITY_CASES = {
    "valid": (event(), None),
    "event_id": (event(event_id=" "), "missing_or_invalid_event_id"),
    "order_id": (event(order_id=""), "missing_order_id"),
    "product_id": (event(product_id=" "), "missing_product_id"),
    "event_type": (event(event_type="order_deleted"), "unsupported_event_type"),
    "event_timestamp": (event(event_timestamp="not-a-timestamp"), "invalid_event_timestamp"),
    "quantity": (event(quantity=0), "invalid_quantity"),
    "unit_price": (event(unit_price=0.0), "invalid_unit_price"),
    "currency": (event(currency="USD"), "unsupported_currency"),
    "category": (event(category="automotive"), "unsupported_category"),
}

CONTRACT_CASES = [
    (event(), (None, None)),
    (event(promotion_code="SPRING"), (None, None)),
    (event(drop=("order_id",)), ("contract_missing_order_id", None)),
    (event(schema_version=99), ("contract_unsupported_schema_version", None)),
    ("not json", ("contract_invalid_payload", None)),
    (event(drop=("schema_version",)), ("contract_missing_schema_version", None)),
    (event(schema_version="x"), ("contract_invalid_schema_version", None)),
    (event(quantity=0), (None, "invalid_quantity")),
    (event(currency=None), ("contract_missing_currency", None)),
    (event(quantity="two"), (None, "invalid_quantity")),
    (event(drop=("customer_id",)), (None, None)),
    ("{}", ("contract_missing_schema_version", None)),
    ("null", ("contract_invalid_payload", None)),
    ("[1]", ("contract_invalid_payload", None)),
    ('"text"', ("contract_invalid_payload", None)),
    ("7", ("contract_invalid_payload", None)),
    ("", ("contract_invalid_payload", None)),
    (event(order_id=None, event_id=None), ("contract_missing_event_id", None)),
    # Earlier rules decide: two faults, the first in order is reported.
    (event(quantity=0, currency="USD"), (None, "invalid_quantity")),
]


@pytest.mark.parametrize("strict", [False, True])
def test_quality_cases(judge_payloads, strict):
    codes = judge_payloads([payload for payload, _ in QUALITY_CASES.values()], strict)
    assert codes == [(None, code) for _, code in QUALITY_CASES.values()]


@pytest.mark.parametrize("strict", [False, True])
def test_contract_cases(judge_payloads, strict):
    assert judge_payloads([payload for payload, _ in CONTRACT_CASES], strict) == [want for _, want in CONTRACT_CASES]


def test_each_missing_field_has_its_code(judge_payloads):
    fields = [r.name.removesuffix("_present") for r in contract_rules()[4:]]
    codes = judge_payloads([event(drop=(f,)) for f in fields])
    assert codes == [(f"contract_missing_{f}", None) for f in fields]
    assert len(fields) == 9


def test_repeated_keys_count_first_for_presence_and_last_for_value(judge_payloads):
    first_null = event().replace('"quantity": 3', '"quantity": null, "quantity": 3')
    last_null = event().replace('"quantity": 3', '"quantity": 3, "quantity": null')
    assert judge_payloads([first_null, last_null]) == [
        ("contract_missing_quantity", None),
        (None, "invalid_quantity"),
    ]


# Where the strict rules refuse what the stream accepts.
DISAGREEMENTS = [
    (event(event_id=7), None, "missing_or_invalid_event_id"),
    (event(order_id={"a": 1}), None, "missing_order_id"),
    (event(event_id="\t"), None, "missing_or_invalid_event_id"),
    (event(product_id=" "), None, "missing_product_id"),
    (event().replace("17.25", "NaN"), None, "invalid_unit_price"),
    (event(event_timestamp="2026"), None, "invalid_event_timestamp"),
    (event(event_timestamp="2026-08"), None, "invalid_event_timestamp"),
    (event(event_timestamp="12:00"), None, "invalid_event_timestamp"),
    (event(event_timestamp=" 2026-08-19T12:00:00"), None, "invalid_event_timestamp"),
    (event(event_timestamp="2026-08-19T12:00:00 Europe/London"), None, "invalid_event_timestamp"),
    (event(event_timestamp="20260819"), "invalid_event_timestamp", "invalid_event_timestamp"),
    (event(event_timestamp="2026-W34-3"), "invalid_event_timestamp", "invalid_event_timestamp"),
    (event(event_timestamp="2026-08-19"), None, None),
    (event(event_timestamp="2026-08-19T12:00:00Z"), None, None),
    (event(event_timestamp="2026-08-19T12:00:00.858263+01:00"), None, None),
]


def test_documented_disagreements(judge_payloads):
    payloads = [p for p, _, _ in DISAGREEMENTS]
    assert [q for _, q in judge_payloads(payloads)] == [lenient for _, lenient, _ in DISAGREEMENTS]
    assert [q for _, q in judge_payloads(payloads, strict=True)] == [strict for _, _, strict in DISAGREEMENTS]


def test_loose_json_is_accepted_and_versions_must_be_integers(judge_payloads):
    loose = [event() + " trailing", event().replace('"', "'")]
    assert judge_payloads(loose) == [(None, None)] * 2
    odd_versions = [event(schema_version=v) for v in ("1", True, 1.5)]
    assert judge_payloads(odd_versions) == [("contract_invalid_schema_version", None)] * 3


def test_rule_names_and_codes_are_unique():
    rules = contract_rules() + quality_rules()
    assert len({r.name for r in rules}) == len({r.code for r in rules}) == len(rules) == 22


def test_parity_of_cases(spark, judge_payloads):
    names = list(QUALITY_CASES)
    got = judge_payloads([QUALITY_CASES[n][0] for n in names])
    schema = "case string, code string"
    expected = spark.createDataFrame([(n, QUALITY_CASES[n][1]) for n in names] + [("only here", None)], schema)
    actual = spark.createDataFrame([(n, q) for n, (_, q) in zip(names, got)], schema)
    rows = compare_cases(expected, actual, "case", "code").collect()
    assert {r["case"] for r in rows if not r.matches} == {"only here"}


def test_missing_keys_are_found_whichever_parse_answers(spark):
    """The short answer for payloads that plainly hold each key once agrees with looking every key up."""
    plain = json.dumps({**BASE_EVENT, "customer_id": "C"}, separators=(",", ":"))
    body = plain[1:-1]
    payloads = [
        plain, json.dumps(BASE_EVENT), plain.replace(",", ", "), plain.replace(":", " :"), f"{plain} tail", plain[:-1],
        f'{{"event_id":null,{body}}}', f'{{"event_id" :null,{body}}}', f'{{"event_id"\t:null,{body}}}',
        f'{{"event\\u005fid":null,{body}}}', f"{{'event_id':null,{body}}}", f'{{{body},"event_id":null}}',
        plain.replace('"customer_id":"C"', '"event_id" : null'), plain.replace('"customer_id":"C",', ""),
        f'{{{body},"more":{{"event_id":null}}}}', plain.replace('"C"', '":"'), plain.replace('"C"', '"it\'s"'),
        f'{{"currency":null,{plain.replace(chr(34) + "customer_id" + chr(34) + ":" + chr(34) + "C" + chr(34) + ",", "")[1:]}',
        *(json.dumps({**BASE_EVENT, k: v}, separators=(",", ":")) for k in BASE_EVENT for v in (None, 5, {"a": 1})),
        *(json.dumps({n: v for n, v in BASE_EVENT.items() if n != k}) for k in BASE_EVENT), "", "{}", "[]", "null", None,
    ]
    names = ", ".join(f"'{n}'" for n in ("schema_version", *S.REQUIRED_FIELDS))
    rows = spark.createDataFrame([(p,) for p in payloads], "p string").repartition(1)
    found = rows.select("p", F.inline(payload_parses("p"))).select("p", "unreadable", "first_missing")
    each = rows.selectExpr("p", "from_json(p, 'map<string,string>') AS m").selectExpr(
        "p", "m IS NULL AS unreadable",
        f"get(filter(array({names}), name -> try_element_at(m, name) IS NULL), 0) AS first_missing",
    )
    assert sorted(found.collect(), key=repr) == sorted(each.collect(), key=repr)

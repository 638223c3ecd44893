from decimal import Decimal

from larchmart.operators.staging import parse_entity, rejects


def test_json_leniency(raw):
    docs = [
        {"order_item_id": "I1", "order_id": "O1", "product_id": "P1", "quantity": "5", "unit_price": 149.9, "extra": 1},
        {"order_item_id": "I2", "order_id": "O1", "product_id": "P1", "quantity": None, "unit_price": "2.50"},
        {"order_item_id": "I3", "order_id": "O1"},
    ]
    rows = {r.order_item_id: r for r in parse_entity(raw(docs), "order_items").collect()}
    assert rows["I1"].quantity == 5 and rows["I1"].unit_price == Decimal("149.90")
    assert rows["I2"].quantity is None and rows["I2"].unit_price == Decimal("2.50")
    assert rows["I3"].product_id is None and rows["I3"].quantity is None


def test_conversion_flag(raw):
    vals = [True, "true", "TRUE", 1, "1", False, None]
    docs = [{"session_id": f"S{i}", "converted": v} for i, v in enumerate(vals)] + [{"session_id": "S7"}]
    got = {r.session_id: r.is_converted for r in parse_entity(raw(docs), "sessions").collect()}
    assert [got[f"S{i}"] for i in range(8)] == [True, True, True, True, True, False, False, False]


def test_typed_columns_and_timestamps(raw):
    docs = [{"customer_id": "C1", "created_at": "2023-09-14 10:22:31", "updated_at": "2024-01-01 00:00:07.179575"}]
    r = parse_entity(raw(docs), "customers").first()
    assert r.updated_at.microsecond == 179575 and r.created_at.second == 31


def test_rejects(raw):
    docs = ['{"order_item_id": "I1", "quantity": "five"}', "not json", {"order_item_id": "I2", "quantity": 2}]
    bad = {r.id: r.bad_keys for r in rejects(raw(docs), "order_items").collect()}
    assert bad == {0: ["quantity"], 1: []}


def test_rejects_of_every_kind(spark, raw):
    """What is not one JSON object, and values that do not cast; null payloads, too."""
    texts = ['{"quantity": 1}', '  {"quantity": "2"}\n', "{}", "", " ", "7", '"x"', "null", "[1]", '[{"quantity": 1}]', "{broken", '{"quantity": 1', '{"quantity": [1]}', '{"quantity": {"a": 1}}', '{"unit_price": "1,5", "quantity": "x"}', '{"quantity": null}']
    frame = raw(texts).unionByName(spark.createDataFrame([(99, None, None)], "id long, payload string, _ingested_at timestamp_ntz"))
    bad = {r.id: r.bad_keys for r in rejects(frame, "order_items").collect()}
    assert bad == {i: [] for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 99)} | {12: ["quantity"], 13: ["quantity"], 14: ["quantity", "unit_price"]}


def test_rejects_parse_each_document_once(raw):
    """A filter on the parsed document does not parse it again for every key."""
    docs = raw([{"order_id": "O1", "gross_amount": "12,50"}, {"order_id": "O2", "gross_amount": 3}, "{cut", "[1]"])
    found = rejects(docs, "orders")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert sorted(r.bad_keys for r in found.collect()) == [[], [], ["gross_amount"]]

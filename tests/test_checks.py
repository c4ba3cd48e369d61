from __future__ import annotations

from keybrook.operators.checks import accepted, check_records, rejected
from keybrook.schemas import SERVICE_ORDER, SERVICE_ORDER_VALIDATION, SERVICE_ORDER_VALUE

GOOD = ("a", 1, "CREATED", "JUMPERS", 2, 9.5)


def ddl(contract):
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in contract)


def test_required_fields_and_symbols(spark):
    rows = [
        GOOD,
        ("b", None, "CREATED", "JUMPERS", 2, None),
        ("c", 1, "LOST", "HATS", 2, 9.5),
        ("d", 1, None, "STOCKINGS", 2, 9.5),
    ]
    orders = spark.createDataFrame(rows, ddl(SERVICE_ORDER))
    found = {
        row.id: (row.missing, row.unknown, row.accepted)
        for row in check_records(orders, SERVICE_ORDER).collect()
    }
    assert found == {
        "a": ([], [], True),
        "b": (["customerId", "price"], [], False),
        "c": ([], ["state", "product"], False),
        "d": (["state"], [], False),
    }
    assert [row.id for row in accepted(orders, SERVICE_ORDER).collect()] == ["a"]
    assert sorted(row.id for row in rejected(orders, SERVICE_ORDER).collect()) == ["b", "c", "d"]


def test_nested_record(spark):
    rows = [(GOOD, 1.0), (None, 1.0), (("b", 1, "LOST", None, 2, 9.5), None)]
    values = spark.createDataFrame(rows, ddl(SERVICE_ORDER_VALUE))
    found = [(row.missing, row.unknown) for row in check_records(values, SERVICE_ORDER_VALUE).collect()]
    assert found == [
        ([], []),
        (["order"], []),
        (["order.product", "value"], ["order.state"]),
    ]


def test_check_symbols(spark):
    rows = [("a", "FRAUD_CHECK", "PASS"), ("b", "OTHER", "PASS")]
    checked = accepted(spark.createDataFrame(rows, ddl(SERVICE_ORDER_VALIDATION)), SERVICE_ORDER_VALIDATION)
    assert [row.orderId for row in checked.collect()] == ["a"]

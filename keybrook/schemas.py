"""Record contracts, declared ahead and never inferred.

All fields are required. Enumerations are strings whose symbols stand in the
field's metadata, where ``operators.checks`` finds them.
"""

from __future__ import annotations

from pyspark.sql import types as T

SYMBOLS = "symbols"


def _required(name: str, data_type: T.DataType, symbols: list[str] | None = None) -> T.StructField:
    return T.StructField(name, data_type, False, {SYMBOLS: symbols} if symbols else None)


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([_required(name, data_type) for name, data_type in fields.items()])


# What every topic holds, whatever its key and value types are.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# ---- fixed values: names of topics, tables and symbols, and field names ----

ORDER_TOPIC = "order"
CUSTOMER_TOPIC = "customer"
PRODUCT_TOPIC = "product"
ENRICHED_ORDER_TOPIC = "enriched-order"
CUSTOMER_STORE = "customer-store"
PRODUCT_STORE = "product-store"

LINES_TOPIC = "walkersTopic"
WORD_COUNTS_TOPIC = "walkTooMuch"

MAIL_TOPIC = "MailTopic"
NEW_MAIL_TOPIC = "NewMailTopic"
ORIGINAL_AND_NEW_MAIL_TOPIC = "OriginalAndNewMailTopic"

GENDERS = ["male", "female", "unknown"]
ORDER_STATES = ["CREATED", "VALIDATED", "FAILED", "SHIPPED"]
GARMENTS = ["JUMPERS", "UNDERPANTS", "STOCKINGS"]
CHECK_TYPES = ["INVENTORY_CHECK", "FRAUD_CHECK", "ORDER_DETAILS_CHECK"]
CHECK_RESULTS = ["PASS", "FAIL", "ERROR"]

# Records of the enrichment. The ids of all three are in the record key only.
ORDER = _record(
    customer_id=T.LongType(),
    product_id=T.LongType(),
    time_order_placed_at=T.LongType(),  # a bare number, not a timestamp
)
CUSTOMER = _record(name=T.StringType(), gender=T.StringType(), region=T.StringType())
PRODUCT = _record(name=T.StringType(), description=T.StringType(), supplier_name=T.StringType())
ENRICHED_ORDER = _record(product=PRODUCT, customer=CUSTOMER, order=ORDER)

# Records of the order service: contracts for checks, no operator reads them.
SERVICE_ORDER = T.StructType([
    _required("id", T.StringType()),
    _required("customerId", T.LongType()),
    _required("state", T.StringType(), ORDER_STATES),
    _required("product", T.StringType(), GARMENTS),
    _required("quantity", T.IntegerType()),
    _required("price", T.DoubleType()),
])
SERVICE_ORDER_VALUE = _record(order=SERVICE_ORDER, value=T.DoubleType())
SERVICE_CUSTOMER = _record(
    id=T.LongType(),
    firstName=T.StringType(),
    lastName=T.StringType(),
    email=T.StringType(),
    address=T.StringType(),
)
SERVICE_PAYMENT = _record(
    id=T.StringType(), orderId=T.StringType(), ccy=T.StringType(), amount=T.DoubleType()
)
SERVICE_ORDER_VALIDATION = T.StructType([
    _required("orderId", T.StringType()),
    _required("checkType", T.StringType(), CHECK_TYPES),
    _required("validationResult", T.StringType(), CHECK_RESULTS),
])

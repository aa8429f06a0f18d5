"""Column types of the nine raw tables and of the result files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


STR, INT = T.StringType(), T.IntegerType()
TIME = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
DEGREES = T.DecimalType(10, 7)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class TableSpec:
    """How one raw file is read, cleaned and checked."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    distinct_on: tuple[str, ...] = ()
    multi_line: bool = False  # quoted line breaks; such a file is read by one task


CUSTOMERS = TableSpec(
    "customers",
    _schema(
        customer_id=STR,
        customer_unique_id=STR,
        customer_zip_code_prefix=INT,
        customer_city=STR,
        customer_state=STR,
    ),
    key=("customer_id",),
)
GEOLOCATION = TableSpec(
    "geolocation",
    _schema(
        geolocation_zip_code_prefix=INT,
        geolocation_lat=DEGREES,
        geolocation_lng=DEGREES,
        geolocation_city=STR,
        geolocation_state=STR,
    ),
    distinct_on=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
)
SELLERS = TableSpec(
    "sellers",
    _schema(
        seller_id=STR,
        seller_zip_code_prefix=INT,
        seller_city=STR,
        seller_state=STR,
    ),
    key=("seller_id",),
)
TRANSLATION = TableSpec(
    "category_translation",
    _schema(
        product_category_name=STR,
        product_category_name_english=STR,
    ),
    key=("product_category_name",),
)
PRODUCTS = TableSpec(
    "products",
    _schema(
        product_id=STR,
        product_category_name=STR,
        product_name_lenght=INT,
        product_description_lenght=INT,
        product_photos_qty=INT,
        product_weight_g=INT,
        product_length_cm=INT,
        product_height_cm=INT,
        product_width_cm=INT,
    ),
    key=("product_id",),
)
ORDERS = TableSpec(
    "orders",
    _schema(
        order_id=STR,
        customer_id=STR,
        order_status=STR,
        order_purchase_timestamp=TIME,
        order_approved_at=TIME,
        order_delivered_carrier_date=TIME,
        order_delivered_customer_date=TIME,
        order_estimated_delivery_date=TIME,
    ),
    key=("order_id",),
)
ORDER_ITEMS = TableSpec(
    "order_items",
    _schema(
        order_id=STR,
        order_item_id=INT,
        product_id=STR,
        seller_id=STR,
        shipping_limit_date=TIME,
        price=MONEY,
        freight_value=MONEY,
    ),
)
PAYMENTS = TableSpec(
    "order_payments",
    _schema(
        order_id=STR,
        payment_sequential=INT,
        payment_type=STR,
        payment_installments=INT,
        payment_value=MONEY,
    ),
)
REVIEWS = TableSpec(
    "order_reviews",
    _schema(
        review_id=STR,
        order_id=STR,
        review_score=INT,
        review_comment_title=STR,
        review_comment_message=STR,
        review_creation_date=TIME,
        review_answer_timestamp=TIME,
    ),
    key=("review_id",),
    multi_line=True,
)
RAW_TABLES = (CUSTOMERS, GEOLOCATION, SELLERS, TRANSLATION, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS, REVIEWS)

SELECTION_DOCUMENT = (
    "global_default_model string, global_default_reason string, category_wins map<string,bigint>, "
    "per_category map<string, struct<selected_model:string, confidence:string, reason:string, mapes:map<string,double>>>"
)

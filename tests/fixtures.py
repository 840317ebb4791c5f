"""Small marketplace frames holding the edge cases listed in FIXTURES.md."""

import datetime as dt

from stellate.sources.marketplace import Marketplace

T = dt.datetime

REVIEWS_SCHEMA = (
    "review_id string, order_id string, review_score int, "
    "review_creation_date timestamp, review_answer_timestamp timestamp"
)
REVIEWS = [
    # same review_id on two orders
    ("r1", "o1", 5, T(2017, 1, 2), T(2017, 1, 3)),
    ("r1", "o2", 5, T(2017, 1, 2), T(2017, 1, 3)),
    # the same review row twice
    ("r2", "o3", 4, T(2017, 2, 2), T(2017, 2, 4)),
    ("r2", "o3", 4, T(2017, 2, 2), T(2017, 2, 4)),
    # unique
    ("r3", "o4", 1, T(2017, 3, 1), T(2017, 3, 2)),
    # NULL review_id twice
    (None, "o5", 3, T(2017, 4, 1), T(2017, 4, 2)),
    (None, "o6", 2, T(2017, 4, 1), T(2017, 4, 3)),
]

CUSTOMERS_SCHEMA = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string"
)
CUSTOMERS = [
    ("c1", "u1", "01001", "sao paulo", "SP"),
    ("c2", "u2", "20000", "rio de janeiro", "RJ"),
    # one customer_unique_id with two customer_ids and two zips
    ("c3", "u3", "30000", "belo horizonte", "MG"),
    ("c4", "u3", "30001", "belo horizonte", "MG"),
    # the same customer row twice (distinct must collapse it)
    ("c5", "u5", "40000", "salvador", "BA"),
    ("c5", "u5", "40000", "salvador", "BA"),
]

ORDERS_SCHEMA = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)
ORDERS = [
    ("o1", "c1", "delivered", T(2017, 1, 1, 10), T(2017, 1, 1, 11), T(2017, 1, 2), T(2017, 1, 5), T(2017, 1, 10)),
    ("o2", "c2", "delivered", T(2017, 1, 3, 9), T(2017, 1, 3, 10), T(2017, 1, 4), T(2017, 1, 8), T(2017, 1, 12)),
    ("o3", "c3", "shipped", T(2017, 2, 1, 8), T(2017, 2, 1, 9), T(2017, 2, 2), None, T(2017, 2, 15)),
    ("o4", "c5", "delivered", T(2018, 3, 1, 8), None, None, None, T(2018, 3, 20)),
    # order without customer
    ("o5", "c9", "canceled", T(2018, 4, 1, 8), None, None, None, T(2018, 4, 20)),
    # order without payment
    ("o6", "c4", "delivered", T(2018, 5, 1, 8), T(2018, 5, 1, 9), T(2018, 5, 2), T(2018, 5, 6), T(2018, 5, 20)),
]

PAYMENTS_SCHEMA = (
    "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double"
)
PAYMENTS = [
    ("o1", 1, "credit_card", 3, 100.0),
    # one order with two payments
    ("o2", 1, "voucher", 1, 20.0),
    ("o2", 2, "credit_card", 2, 80.0),
    ("o3", 1, "boleto", 1, 55.5),
    # NULL payment type
    ("o4", 1, None, 1, 10.0),
    # payment without order
    ("o9", 1, "debit_card", 1, 12.0),
]

PRODUCTS_SCHEMA = (
    "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int"
)
PRODUCTS = [
    ("p1", "perfumaria", 40, 287, 1, 225, 16, 10, 14),
    ("p2", "artes", 44, 276, 1, 1000, 30, 18, 20),
    # unknown category
    ("p3", "categoria_nova", 46, 250, 1, 154, 18, 9, 15),
    # NULL category
    ("p4", None, None, None, None, 625, 20, 17, 13),
]

TRANSLATION_SCHEMA = "product_category_name string, product_category_name_english string"
TRANSLATION = [("perfumaria", "perfumery"), ("artes", "art")]

GEO_SCHEMA = (
    "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string"
)
GEO = [
    ("01001", -23.55, -46.63, "sao paulo", "SP"),
    ("01001", -23.56, -46.64, "sao paulo", "SP"),
    # zip prefix with two cities
    ("20000", -22.90, -43.20, "rio de janeiro", "RJ"),
    ("20000", -22.91, -43.21, "rio", "RJ"),
    ("30000", -19.91, -43.93, "belo horizonte", "MG"),
]


def marketplace(spark) -> Marketplace:
    customers = spark.createDataFrame(CUSTOMERS, CUSTOMERS_SCHEMA)
    items = spark.createDataFrame([("o1", 1, "p1")], "order_id string, order_item_id int, product_id string")
    sellers = spark.createDataFrame([("s1", "01001")], "seller_id string, seller_zip_code_prefix string")
    return Marketplace(
        customers=customers,
        customer_orders=customers,
        orders=spark.createDataFrame(ORDERS, ORDERS_SCHEMA),
        order_payments=spark.createDataFrame(PAYMENTS, PAYMENTS_SCHEMA),
        products=spark.createDataFrame(PRODUCTS, PRODUCTS_SCHEMA),
        category_translation=spark.createDataFrame(TRANSLATION, TRANSLATION_SCHEMA),
        geolocation=spark.createDataFrame(GEO, GEO_SCHEMA),
        order_items=items,
        sellers=sellers,
    )


def reviews(spark):
    return spark.createDataFrame(REVIEWS, REVIEWS_SCHEMA)

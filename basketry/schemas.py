"""Schemas of the tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


S, D, L, I, DATE = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()

SALES_VALUE = "invoice_value_with_discount_and_without_iva"

SALES = _struct(("date_sale", DATE), ("id_client", S), ("product", S), (SALES_VALUE, D), ("amount", D))

DETAIL = _struct(("product", S), ("amount", D), (SALES_VALUE, D), ("tax", D))

RAW_TICKETS = _struct(
    ("ID", L),
    ("date_sale", DATE),
    ("identification_doct", S),
    ("invoice_value_without_iva_and_discount", D),
    ("id_point_sale", S),
    ("domicilio_status", S),
    ("invoice_details", T.ArrayType(DETAIL)),
)

LANDED_TICKETS = T.StructType([*RAW_TICKETS.fields, T.StructField("month", S)])

CATALOG = _struct(("codigo_unico", S), ("description", S))

DAILY = _struct(
    ("client", S), ("date", DATE), ("qty_tot", D), ("amount_tot", D), ("skus", L), ("purchased", I)
)

VIP_COLUMNS = (
    "tiket_id",
    "date_sale",
    "user_id",
    "tiket_price",
    "amount",
    "category",
    "product_name",
    "tax",
    "id_point_sale",
    "domicilio_status",
)

VIP_LINES = _struct(
    ("tiket_id", L),
    ("date_sale", DATE),
    ("user_id", S),
    ("tiket_price", D),
    ("amount", D),
    ("category", S),
    ("product_name", S),
    ("tax", D),
    ("id_point_sale", S),
    ("domicilio_status", S),
)

CONTACT_COLUMNS = (
    "name",
    "email",
    "phone",
    "document_type",
    "country",
    "department",
    "town",
    "gender",
)

PREDICTIONS = _struct(("date", S), ("client", S), ("prob", D))

ITEM_RECS = _struct(
    ("client", S), ("recommended_product", S), ("recommendation_score", D), ("recommendation_rank", I)
)

LIST_RECS = _struct(("client", S), ("recommended_products", T.ArrayType(S)))

CLUSTER_RECS = _struct(
    ("client", S),
    ("purchase_pattern_cluster", I),
    ("segment", S),
    ("segment_label", S),
    ("recommended_products", T.ArrayType(S)),
)

"""Explicit schemas of the JSON documents carried as text in Bronze."""

from pyspark.sql import types as T

TENANT_SETTINGS = T.StructType([
    T.StructField("plan_type", T.StringType()),
    T.StructField("max_users", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.StringType())),
])

CUSTOMER_METADATA = T.StructType([
    T.StructField("age", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("signup_source", T.StringType()),
    T.StructField("preferences", T.StructType([
        T.StructField("newsletter", T.BooleanType()),
        T.StructField("notifications", T.BooleanType()),
    ])),
])

ORDER_METADATA = T.StructType([
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_address", T.StructType([
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
    ])),
])

# The application writes url / product_id / search_term; the driver's event
# properties carry a numeric ``k``.  Absent fields parse to NULL.
EVENT_DATA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("search_term", T.StringType()),
    T.StructField("k", T.IntegerType()),
])

"""Column contracts of each layer. Every field is nullable."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """Schema from text at import time; ``StructType.fromDDL`` needs a running session."""
    fields = [item.split() for item in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Layer schemas in file order.
_CUSTOMERS = """
    ssn string, cc_num long, first string, last string, gender string, street string,
    city string, state string, zip int, lat double, long double, city_pop int,
    job string, dob string, acct_num long, profile string
"""
_SILVER = """
    trans_num string, customer_hash string, event_time timestamp, amt double,
    category string, merchant string, state string, city_pop int, gender string,
    job string, age long, distance_km double, hour int, day_of_week int, month int,
    is_fraud int
"""

CUSTOMERS = _struct(_CUSTOMERS)
TRANSACTIONS = _struct(
    "row_id long, "
    + _CUSTOMERS
    + """, trans_num string, trans_date string, trans_time string, unix_time long,
    category string, amt double, is_fraud int, merchant string,
    merch_lat double, merch_long double"""
)
SILVER = _struct(_SILVER)
GOLD = _struct(_SILVER + ", sample_weight double")
REQUEST = _struct(
    """category string, state string, gender string, amt double, city_pop int,
    age double, distance_km double, hour int, day_of_week int, month int"""
)
HISTORY = _struct(
    "data string, pr_auc_desafiante double, pr_auc_atual double, promovido boolean"
)
RUNS = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

CATEGORICAL = ["category", "state", "gender"]
NUMERIC = ["amt", "city_pop", "age", "distance_km", "hour", "day_of_week", "month"]
FEATURES = CATEGORICAL + NUMERIC

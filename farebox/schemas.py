"""Declared schemas of the trip sources (read with an explicit schema, no
inference pass)."""

from pyspark.sql import types as T

_I, _L, _D, _S, _TS = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


GREEN_SCHEMA = _struct(
    [
        ("VendorID", _I), ("lpep_pickup_datetime", _TS), ("lpep_dropoff_datetime", _TS),
        ("store_and_fwd_flag", _S), ("RatecodeID", _I), ("PULocationID", _L), ("DOLocationID", _L),
        ("passenger_count", _I), ("trip_distance", _D), ("fare_amount", _D), ("extra", _D),
        ("mta_tax", _D), ("tip_amount", _D), ("tolls_amount", _D), ("ehail_fee", _D),
        ("improvement_surcharge", _D), ("total_amount", _D), ("payment_type", _I), ("trip_type", _I),
        ("congestion_surcharge", _D),
    ]
)

YELLOW_SCHEMA = _struct(
    [
        ("VendorID", _I), ("tpep_pickup_datetime", _TS), ("tpep_dropoff_datetime", _TS),
        ("passenger_count", _D), ("trip_distance", _D), ("RatecodeID", _I), ("store_and_fwd_flag", _S),
        ("PULocationID", _I), ("DOLocationID", _I), ("payment_type", _I), ("fare_amount", _D),
        ("extra", _D), ("mta_tax", _D), ("tip_amount", _D), ("tolls_amount", _D),
        ("improvement_surcharge", _D), ("total_amount", _D), ("congestion_surcharge", _D),
    ]
)

INGESTED_SCHEMA = _struct(
    [
        ("tpep_pickup_datetime", _TS), ("tpep_dropoff_datetime", _TS), ("lpep_pickup_datetime", _TS),
        ("lpep_dropoff_datetime", _TS), ("PULocationID", _L), ("DOLocationID", _L), ("fare_amount", _D),
        ("payment_type", _L), ("taxi_type", _S),
    ]
)

PAYMENT_LOOKUP_SCHEMA = _struct([("payment_type_id", _L), ("payment_type_name", _S)])
ZONE_LOOKUP_SCHEMA = _struct([("LocationID", _L), ("Borough", _S), ("Zone", _S), ("service_zone", _S)])
QUESTION_SCHEMA = _struct(
    [("id", _L), ("creation_date", _TS), ("score", _L), ("view_count", _L), ("answer_count", _L), ("tags", _S)]
)

"""The domain mapping of ``farebox.plans.domain`` written in DuckDB SQL.

Used only to build the oracle queries of ``__spark_entry__.oracle_sql``; the
library never runs this text.  Each constant is a parenthesised sub-query
that can be used in a FROM clause or a CTE.
"""

GREEN_FILTER = "event_type IN ('click', 'view', 'signup')"


def _event_trip_select(prefix: str, green: bool) -> str:
    zone_t = "BIGINT" if green else "INTEGER"
    pc_t = "INTEGER" if green else "DOUBLE"
    extra = (
        ", CAST(NULL AS DOUBLE) AS ehail_fee, CAST(event_id % 2 + 1 AS INTEGER) AS trip_type"
        if green
        else ""
    )
    where = GREEN_FILTER if green else f"NOT ({GREEN_FILTER})"
    return f"""(SELECT
        CAST(user_id % 3 AS INTEGER) AS VendorID,
        CAST(ts AS TIMESTAMP) AS {prefix}_pickup_datetime,
        CAST(ts AS TIMESTAMP) + to_seconds(event_id % 1800) AS {prefix}_dropoff_datetime,
        CASE WHEN event_id % 10 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
        CAST(1 AS INTEGER) AS RatecodeID,
        CAST(user_id % 25 AS {zone_t}) AS PULocationID,
        CAST((user_id + event_id) % 25 AS {zone_t}) AS DOLocationID,
        CAST(CAST(user_id % 4 AS INTEGER) AS {pc_t}) AS passenger_count,
        CAST(event_id % 40 AS DOUBLE) * 0.25 AS trip_distance,
        value AS fare_amount,
        CAST(event_id % 3 AS DOUBLE) * 0.5 AS extra,
        CAST(0.5 AS DOUBLE) AS mta_tax,
        CAST(event_id % 5 AS DOUBLE) * 0.25 AS tip_amount,
        CAST(0.0 AS DOUBLE) AS tolls_amount,
        CAST(0.3 AS DOUBLE) AS improvement_surcharge,
        value AS total_amount,
        CAST(event_id % 8 AS INTEGER) AS payment_type,
        CASE WHEN user_id % 2 = 0 THEN CAST(2.5 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
            AS congestion_surcharge
        {extra}
    FROM events WHERE {where})"""


GREEN_RAW = _event_trip_select("lpep", True)
YELLOW_RAW = _event_trip_select("tpep", False)

INGESTED_TRIPS = """(SELECT
    CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS TIMESTAMP) END AS tpep_pickup_datetime,
    CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS TIMESTAMP) + to_hours(l_linenumber) END
        AS tpep_dropoff_datetime,
    CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS TIMESTAMP) END AS lpep_pickup_datetime,
    CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS TIMESTAMP) + to_hours(l_linenumber) END
        AS lpep_dropoff_datetime,
    l_suppkey % 10 AS PULocationID,
    CAST(l_linenumber AS BIGINT) AS DOLocationID,
    l_quantity - 3.0 AS fare_amount,
    l_partkey % 8 AS payment_type,
    CASE WHEN l_linestatus = 'O' THEN 'green' ELSE 'yellow' END AS taxi_type
FROM lineitem)"""

STAGED_LINES = """(SELECT CAST(l_suppkey % 2 + 1 AS BIGINT) AS vendor_id,
    CAST(l_shipdate AS TIMESTAMP) AS pickup_datetime,
    CAST(l_shipdate AS TIMESTAMP) + to_hours(l_linenumber) AS dropoff_datetime,
    CAST(l_suppkey % 4 AS BIGINT) AS pickup_location_id,
    CAST(l_linenumber AS BIGINT) AS dropoff_location_id,
    CAST(l_linenumber % 4 AS BIGINT) AS passenger_count,
    CAST(floor(l_quantity / 10) * 0.125 AS DOUBLE) AS trip_distance,
    CAST(floor(l_quantity / 10) * 5 AS DECIMAL(18,2)) AS total_amount,
    CAST(l_partkey % 3 AS BIGINT) AS payment_type FROM lineitem)"""

QUESTIONS = """(SELECT l_partkey AS part_id, CAST(l_shipdate AS TIMESTAMP) AS creation_date,
    l_quantity AS score, floor(l_extendedprice) AS view_count FROM lineitem)"""

TAGGED_PARTS = "(SELECT p_partkey AS id, replace(p_name, ' ', '|') AS tags FROM part)"

ZONES = """(SELECT CAST(n_nationkey AS BIGINT) AS LocationID, n_name AS zone_name,
    n_regionkey AS region_id FROM nation)"""

PAYMENT_LOOKUP = """(SELECT * FROM (VALUES
    (0, 'flex_fare'), (1, 'credit_card'), (2, 'cash'), (3, 'no_charge'),
    (4, 'dispute'), (5, 'unknown'), (6, 'voided_trip'))
    AS p(payment_type_id, payment_type_name))"""

"""Trip models (M1–M8, M13–M18) over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.columns import payment_type_name, surrogate_key, vendor_name
from farebox.operators import dedupe, normalize, revenue, unions
from farebox.operators.joins import lookup_join
from farebox.plans import domain
from farebox.tables import load, to_ntz

# Lower bound of the hourly reports (covers every benchmark row).
REPORT_SINCE = "2020-01-01 00:00:00"
REPORT_DIGITS = {"digits": domain.SUM_DIGITS}


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = load(spark, sf_dir, "events")
    return domain.green_raw(events), domain.yellow_raw(events)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.zones(load(spark, sf_dir, "nation"))


def service_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both services with canonical time names, common columns, service tag."""
    green, yellow = sources(spark, sf_dir)
    green = normalize.apply_casts(normalize.rename_time_columns(green, "green"))
    yellow = normalize.apply_casts(normalize.rename_time_columns(yellow, "yellow"))
    common = normalize.common_columns(green, yellow)
    return unions.union_tagged({"green": green, "yellow": yellow}, select=common)


# ---------------------------------------------------------------- M15 family
def hourly_revenue_outer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship (M15): hourly green and yellow revenue per zone side by side,
    named by the zone table.  One aggregate over both services (see
    ``revenue.hourly_revenue_by_service``), then a broadcast zone join."""
    trips = service_trips(spark, sf_dir)
    rev = revenue.hourly_revenue_by_service(
        trips, time_col="pickup_datetime", zone_col="PULocationID", since=REPORT_SINCE, digits=domain.SUM_DIGITS
    )
    return to_ntz(revenue.attach_zones(rev, zones(spark, sf_dir)))


def hourly_revenue_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 exactly as composed in the modelled workload: two aggregates, a full
    outer join on (hour, zone), then the zone join."""
    green, yellow = sources(spark, sf_dir)
    g = revenue.hourly_revenue(green, "lpep_pickup_datetime", since=REPORT_SINCE, digits=domain.SUM_DIGITS)
    y = revenue.hourly_revenue(yellow, "tpep_pickup_datetime", since=REPORT_SINCE, digits=domain.SUM_DIGITS)
    return to_ntz(revenue.attach_zones(revenue.hourly_revenue_outer(g, y), zones(spark, sf_dir)))


def hourly_revenue_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two hourly aggregates stacked with a service tag."""
    green, yellow = sources(spark, sf_dir)
    g = revenue.hourly_revenue(green, "lpep_pickup_datetime", since=REPORT_SINCE, digits=domain.SUM_DIGITS)
    y = revenue.hourly_revenue(yellow, "tpep_pickup_datetime", since=REPORT_SINCE, digits=domain.SUM_DIGITS)
    return to_ntz(revenue.hourly_revenue_tagged(g, y))


# ------------------------------------------------------------ unions (M1, P5)
def trips_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + P6 + U2: casts applied where present, sorted common columns,
    service tag, strict union by name."""
    return to_ntz(service_trips(spark, sf_dir))


def trips_union_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + U3: defensive projections (absent -> typed null) unioned with
    missing columns allowed."""
    green, yellow = sources(spark, sf_dir)
    g = normalize.minimal_trips(green, "green")
    y = normalize.minimal_trips(yellow.drop("tolls_amount"), "yellow").drop("tolls_amount")
    return to_ntz(unions.union_by_name(g, y, allow_missing=True))


def staged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: both services staged to the canonical 20 columns, UNION ALL by
    position (layouts asserted equal) plus the service tag."""
    green, yellow = sources(spark, sf_dir)
    g = normalize.stage(green, "green").withColumn("service_type", F.lit("Green"))
    y = normalize.stage(yellow, "yellow").withColumn("service_type", F.lit("Yellow"))
    return unions.union_positional(g, y)


def trips_union_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(staged_union(spark, sf_dir))


def count_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 / Q10: rows per service after the union."""
    return revenue.count_by(service_trips(spark, sf_dir), "service_type", name="trip_count")


# ------------------------------------------------------------ revenue
def monthly_revenue_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(revenue.monthly_revenue_zone(service_trips(spark, sf_dir), **REPORT_DIGITS))


def monthly_revenue_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    green, yellow = sources(spark, sf_dir)
    g = normalize.minimal_trips(green, "green")
    y = normalize.minimal_trips(yellow, "yellow")
    return revenue.monthly_revenue_service(unions.union_by_name(g, y, allow_missing=True), domain.SUM_DIGITS)


# ------------------------------------------------------------ fact + dims (M2–M5)
FACT_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "passenger_count", "trip_distance", "trip_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
    "congestion_surcharge", "total_amount", "payment_type",
]
TRIP_ID_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "passenger_count", "trip_distance", "total_amount", "payment_type",
]


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: enrich with payment name, exact dedupe over all 19 columns, md5
    surrogate id of the plain text of nine columns."""
    staged = staged_union(spark, sf_dir).select(*FACT_COLUMNS)
    # The name is a function of the code, so deduplicating the 18 source
    # columns first gives the same rows with a narrower shuffle.
    deduped = dedupe.exact(staged).withColumn("payment_type_name", payment_type_name("payment_type"))
    return to_ntz(deduped.select(surrogate_key(TRIP_ID_COLUMNS).alias("trip_id"), *deduped.columns))


def dim_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: distinct (vendor id, vendor name), null ids dropped, ordered."""
    staged = staged_union(spark, sf_dir)
    return (
        staged.filter(F.col("vendor_id").isNotNull())
        .select("vendor_id", vendor_name("vendor_id").alias("vendor_name"))
        .distinct()
        .orderBy("vendor_id")
    )


def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: the zone table with typed columns (location id as bigint, borough
    from the region lookup), ordered by location id."""
    z = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    named = lookup_join(z, r, z["n_regionkey"] == r["r_regionkey"], "left")
    return named.select(
        F.col("n_nationkey").cast("long").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.col("n_regionkey").cast("string").alias("service_zone"),
    ).orderBy("location_id")


#: One year, the interval of the report (the years of the benchmark's ship dates).
DUP_START, DUP_END = "1996-01-01 00:00:00", "1997-01-01 00:00:00"


def dup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: staged trips of one year equal on the nine id columns and seen more
    than once, most repeated first, top 50 (the columns break ties at the cut)."""
    staged = domain.staged_lines(load(spark, sf_dir, "lineitem"))
    year = revenue.between_filter(staged, "pickup_datetime", DUP_START, DUP_END)
    return to_ntz(dedupe.duplicate_report(year, TRIP_ID_COLUMNS, top=50))


# ------------------------------------------------------------ asset pipeline (M6–M8)
STAGING_ALTERNATIVES = {
    "pickup_datetime": ["tpep_pickup_datetime", "lpep_pickup_datetime"],
    "dropoff_datetime": ["tpep_dropoff_datetime", "lpep_dropoff_datetime"],
    "pickup_location_id": ["PULocationID", "pu_location_id"],
    "dropoff_location_id": ["DOLocationID", "do_location_id"],
    "fare_amount": ["fare_amount"],
    "taxi_type": ["taxi_type"],
    "payment_type": ["payment_type"],
}
KEY_A = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount"]
KEY_Z = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]
STAGING_OUT = [
    "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
    "fare_amount", "taxi_type", "payment_type_name",
]


def staging_trips(ingested: DataFrame, lookup: DataFrame, start=None, end=None,
                  variant: str = "A", lookup_rows: int | None = None) -> DataFrame:
    """M6 (variant A) / M7 (variant Z): normalise, bound to ``[start, end)``,
    drop invalid rows, name the payment, keep one row per trip key.

    A: key includes the fare; unmatched payment kept (null name).
    Z: key without the fare; locations must be present; the survivor is
       chosen first, then rows whose payment has no name are dropped.
    The survivor is the first row by pickup time, then the remaining output
    columns (nulls first) – a total order, so reruns agree.  ``lookup_rows``
    states the lookup's size when it is fixed by construction (the seed)."""
    t = normalize.coalesced_between(ingested, STAGING_ALTERNATIVES["pickup_datetime"], start, end)
    t = normalize.coalesce_sources(t, STAGING_ALTERNATIVES)
    t = t.filter(
        F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (F.col("fare_amount") >= 0)
    )
    if variant == "Z":
        t = t.filter(F.col("pickup_location_id").isNotNull() & F.col("dropoff_location_id").isNotNull())
    named = lookup_join(t, lookup, t["payment_type"] == lookup["payment_type_id"], "left",
                        known_rows=lookup_rows).select(
        *[c for c in STAGING_OUT]
    )
    key = KEY_A if variant == "A" else KEY_Z
    rest = [c for c in STAGING_OUT if c not in key]
    # Service and payment names are few; the fare passed the filter above, so it is no null.
    few = {"taxi_type": dedupe.few_values(ingested, "taxi_type"), "payment_type_name": dedupe.few_values(lookup, "payment_type_name")}
    kept = dedupe.keep_one_coded(named, key, ["pickup_datetime", *rest], few, required=["fare_amount"])
    if variant == "Z":
        kept = kept.filter(F.col("payment_type_name").isNotNull())
    return kept.select(*STAGING_OUT)


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return domain.ingested_trips(load(spark, sf_dir, "lineitem"))


def dedupe_keep_one_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(staging_trips(ingested(spark, sf_dir), domain.payment_lookup(spark), variant="A",
                               lookup_rows=domain.PAYMENT_LOOKUP_SIZE))


def dedupe_keep_one_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(staging_trips(ingested(spark, sf_dir), domain.payment_lookup(spark), variant="Z",
                               lookup_rows=domain.PAYMENT_LOOKUP_SIZE))


REPORT_START, REPORT_END = "1997-01-01 00:00:00", "2000-01-01 00:00:00"


def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 variant Z over the whole staged table."""
    staged = staging_trips(ingested(spark, sf_dir), domain.payment_lookup(spark), variant="Z",
                               lookup_rows=domain.PAYMENT_LOOKUP_SIZE)
    return revenue.daily_report(staged, **REPORT_DIGITS)


def daily_report_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 variant A on one run interval (``[start, end)`` is the feature):
    the null payment name of unmatched codes is kept."""
    staged = staging_trips(ingested(spark, sf_dir), domain.payment_lookup(spark),
                           REPORT_START, REPORT_END, variant="A", lookup_rows=domain.PAYMENT_LOOKUP_SIZE)
    return revenue.daily_report(staged, REPORT_START, REPORT_END, null_payment_label=None, **REPORT_DIGITS)


def dup_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 / Q6 on the raw ingest: rows minus distinct trip keys, for both key
    sets, computed in one pass."""
    t = normalize.coalesce_sources(ingested(spark, sf_dir), STAGING_ALTERNATIVES)
    return dedupe.excess_rows(t, {"excess_key_a": KEY_A, "excess_key_z": KEY_Z})


# ------------------------------------------------------------ homework
def zone_frequency_bottom(spark: SparkSession, sf_dir: str) -> DataFrame:
    green, _ = sources(spark, sf_dir)
    return revenue.zone_frequency(green, zones(spark, sf_dir), "PULocationID", n=10)


def longest_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 + A13: longest order-to-ship time in hours."""
    orders = load(spark, sf_dir, "orders")
    lineitem = load(spark, sf_dir, "lineitem")
    # The order date is constant per order, so only each order's last ship
    # date can give the maximum: reduce the lines per order first (map-side),
    # then join one row per order instead of every line.
    last_ship = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("l_shipdate"))
    joined = last_ship.join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return revenue.longest_trip_hours(joined, "o_orderdate", "l_shipdate")


def one_day_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14 + A1: trips picked up on one calendar day."""
    green, yellow = sources(spark, sf_dir)
    return revenue.count_on_day(yellow, "tpep_pickup_datetime", "2024-01-15")


def over_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    green, _ = sources(spark, sf_dir)
    return revenue.threshold_counters(green, "trip_distance", 5.0)


def total_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, yellow = sources(spark, sf_dir)
    return revenue.global_sum(yellow, "tip_amount", "total_tip_amount", domain.SUM_DIGITS)


def longest_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest trip in hours (dropoff - pickup) of the yellow trips."""
    _, yellow = sources(spark, sf_dir)
    return revenue.longest_trip_hours(yellow, "tpep_pickup_datetime", "tpep_dropoff_datetime")

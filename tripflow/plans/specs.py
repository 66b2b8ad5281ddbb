"""The trip-data pipeline as data: rules, checks, measures, labels.

Everything the jobs in :mod:`tripflow.plans` compute is declared here;
the operators themselves know nothing about trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.columns import TRIP, TripColumns
from tripflow.functions.expr import in_month, seconds_between
from tripflow.operators.profile import Check
from tripflow.operators.rules import Rule, Step, required_rules
from tripflow.operators.summarise import Label, Measure, Summary
from tripflow.session import env_float
from tripflow.sources.io import INTEGRAL, NUMERIC, TIMESTAMP, check_schema

# ---------------------------------------------------------------------------
# These must stay equal to the pipeline being reproduced.
# ---------------------------------------------------------------------------
TARGET_YEAR, TARGET_MONTH = 2026, 1
DISTANCE_MAX = 200
FARE_MIN, FARE_MAX = 2.5, 500
TOTAL_MAX = 1000
PASSENGERS_MIN, PASSENGERS_MAX = 1, 6
VALID_VENDORS = (1, 2)
TRIP_SECONDS_MIN, TRIP_SECONDS_MAX = 60, 21600
IQR_MULTIPLIERS = (1.5, 2.0, 2.5, 3.0)
IQR_MIN_RETAIN_RATIO = 0.90
IQR_MIN_RETAIN_ENV = "IQR_MIN_RETAIN_RATIO"
QUANTILE_PROBS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
FARE_HISTOGRAM = (0.0, 100.0, 50)  # low, high, bins
TOP_PICKUPS, TOP_ROUTES = 20, 50
DAY_NAMES = {1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday", 5: "Thursday", 6: "Friday"}
DAY_DEFAULT = "Saturday"
VENDOR_NAMES = {1: "Creative Mobile", 2: "VeriFone"}
VENDOR_DEFAULT = "Unknown"
PAYMENT_NAMES = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
PAYMENT_DEFAULT = "Other"
# fields of TripColumns a silver row must have, and those the profile watches
CRITICAL = ("pickup", "dropoff", "distance", "fare", "total", "pickup_loc", "dropoff_loc", "vendor", "passengers")
PROFILE_CRITICAL = ("pickup", "dropoff", "distance", "fare", "passengers", "vendor")
# ---------------------------------------------------------------------------


def critical_columns(c: TripColumns = TRIP) -> tuple[str, ...]:
    """Columns a silver row must have (null or NaN drops the row)."""
    return tuple(getattr(c, f) for f in CRITICAL)


def profile_critical_columns(c: TripColumns = TRIP) -> tuple[str, ...]:
    return tuple(getattr(c, f) for f in PROFILE_CRITICAL)


def trip_schema(c: TripColumns = TRIP) -> dict[str, tuple[type, ...]]:
    """The columns every job needs, with the types it takes.  Timestamps
    are zone-less: with a zone, the month and the hour would depend on the
    session."""
    wanted = {n: TIMESTAMP for n in (c.pickup, c.dropoff)}
    wanted |= {n: NUMERIC for n in (c.distance, c.fare, c.tip, c.total)}
    wanted |= {n: INTEGRAL for n in (c.vendor, c.passengers, c.payment, c.pickup_loc, c.dropoff_loc)}
    return wanted


def check_trips(df: DataFrame, c: TripColumns = TRIP) -> DataFrame:
    return check_schema(df, trip_schema(c))


def range_rules(c: TripColumns = TRIP) -> tuple[Rule, ...]:
    d, f, t, p = F.col(c.distance), F.col(c.fare), F.col(c.total), F.col(c.passengers)
    return (
        Rule("distance > 0", d > 0),
        Rule(f"distance <= {DISTANCE_MAX}", d <= DISTANCE_MAX),
        Rule(f"fare >= {FARE_MIN}", f >= FARE_MIN),
        Rule(f"fare <= {FARE_MAX}", f <= FARE_MAX),
        Rule("total > 0", t > 0),
        Rule(f"total <= {TOTAL_MAX}", t <= TOTAL_MAX),
        Rule(f"passengers >= {PASSENGERS_MIN}", p >= PASSENGERS_MIN),
        Rule(f"passengers <= {PASSENGERS_MAX}", p <= PASSENGERS_MAX),
        Rule("tip >= 0", F.col(c.tip) >= 0),
        Rule("vendor in (1, 2)", F.col(c.vendor).isin(*VALID_VENDORS)),
    )


def time_rules(c: TripColumns = TRIP, year: int = TARGET_YEAR, month: int = TARGET_MONTH) -> tuple[Rule, ...]:
    secs = seconds_between(c.pickup, c.dropoff)
    return (
        Rule("dropoff > pickup", F.col(c.dropoff) > F.col(c.pickup)),
        Rule(f"duration >= {TRIP_SECONDS_MIN}s", secs >= TRIP_SECONDS_MIN),
        Rule(f"duration <= {TRIP_SECONDS_MAX}s", secs <= TRIP_SECONDS_MAX),
        Rule(f"pickup in {year:04d}-{month:02d}", in_month(c.pickup, year, month)),
    )


def cleaning_steps(
    df: DataFrame, c: TripColumns = TRIP, year: int = TARGET_YEAR, month: int = TARGET_MONTH
) -> list[Step]:
    """Steps applied after whole-row dedupe, in order."""
    return [
        Step("required", required_rules(df, critical_columns(c))),
        Step("range", range_rules(c)),
        Step("time", time_rules(c, year, month)),
    ]


def min_retain_ratio(default: float = IQR_MIN_RETAIN_RATIO) -> float:
    return env_float(IQR_MIN_RETAIN_ENV, default)


def iqr_columns(c: TripColumns = TRIP) -> tuple[str, ...]:
    return (c.distance, c.fare, c.total)


def describe_columns(c: TripColumns = TRIP) -> tuple[str, ...]:
    return (c.passengers, c.distance, c.fare, c.tip, c.total)


def range_columns(c: TripColumns = TRIP) -> tuple[str, ...]:
    return (c.distance, c.fare, c.total)


def quantile_columns(c: TripColumns = TRIP) -> tuple[str, ...]:
    return (c.distance, c.fare)


def out_of_month(c: TripColumns = TRIP, year: int = TARGET_YEAR, month: int = TARGET_MONTH):
    """Pickup outside the target month (a null pickup is not counted)."""
    return ~in_month(c.pickup, year, month)


def profile_checks(c: TripColumns = TRIP, year: int = TARGET_YEAR, month: int = TARGET_MONTH) -> list[Check]:
    """Profile issue list (looser than cleaning: fare < 0, passengers = 0)."""
    checks = [Check(f"null {col}", "null", F.col(col).isNull()) for col in profile_critical_columns(c)]
    checks += [
        Check("distance <= 0", "range", F.col(c.distance) <= 0),
        Check("fare < 0", "range", F.col(c.fare) < 0),
        Check("passengers = 0", "range", F.col(c.passengers) == 0),
        Check("dropoff <= pickup", "time", F.col(c.dropoff) <= F.col(c.pickup)),
        Check(f"outside {year:04d}-{month:02d}", "time", out_of_month(c, year, month)),
    ]
    return checks


def _m(name: str, agg: str, column: str | None = None, digits: int | None = 2) -> Measure:
    return Measure(name, agg, column, None if agg == "count" else digits)


def gold_specs(c: TripColumns = TRIP) -> dict[str, Summary]:
    """The eight gold tables."""
    n = Measure("total_trips", "count")
    pax = Measure("total_passengers", "sum", c.passengers)
    day = Label("day_name", c.dayofweek, DAY_NAMES, DAY_DEFAULT)
    vendor = Label("vendor_name", c.vendor, VENDOR_NAMES, VENDOR_DEFAULT)
    payment = Label("payment_name", c.payment, PAYMENT_NAMES, PAYMENT_DEFAULT)
    specs = [
        Summary(
            "by_hour",
            (c.hour,),
            (
                n,
                pax,
                _m("avg_distance_miles", "avg", c.distance),
                _m("avg_fare", "avg", c.fare),
                _m("total_revenue", "sum", c.total),
                _m("avg_tip_pct", "avg", c.tip_pct),
                _m("avg_duration_min", "avg", c.duration_min),
                _m("avg_speed_mph", "avg", c.speed),
            ),
            order=((c.hour, True),),
        ),
        Summary(
            "by_dayofweek",
            (c.dayofweek,),
            (
                n,
                _m("avg_distance", "avg", c.distance),
                _m("total_revenue", "sum", c.total),
                _m("avg_fare", "avg", c.fare),
                _m("avg_tip_pct", "avg", c.tip_pct),
            ),
            labels=(day,),
            order=((c.dayofweek, True),),
        ),
        Summary(
            "by_date",
            (c.date,),
            (
                n,
                pax,
                _m("avg_distance", "avg", c.distance),
                _m("total_revenue", "sum", c.total),
                _m("total_fare", "sum", c.fare),
                _m("total_tips", "sum", c.tip),
                _m("avg_fare", "avg", c.fare),
                _m("avg_tip_pct", "avg", c.tip_pct),
                _m("avg_duration_min", "avg", c.duration_min),
            ),
            order=((c.date, True),),
        ),
        Summary(
            "by_dow_hour",
            (c.dayofweek, c.hour),
            (n, _m("avg_revenue", "avg", c.total)),
            order=((c.dayofweek, True), (c.hour, True)),
        ),
        Summary(
            "by_vendor",
            (c.vendor,),
            (
                n,
                pax,
                _m("avg_distance", "avg", c.distance),
                _m("total_revenue", "sum", c.total),
                _m("avg_revenue_per_trip", "avg", c.total),
                _m("avg_fare", "avg", c.fare),
                _m("total_tips", "sum", c.tip),
                _m("avg_tip_pct", "avg", c.tip_pct),
                _m("avg_duration_min", "avg", c.duration_min),
                _m("avg_speed_mph", "avg", c.speed),
            ),
            labels=(vendor,),
            order=((c.vendor, True),),
        ),
        Summary(
            "by_payment",
            (c.payment,),
            (
                n,
                _m("total_revenue", "sum", c.total),
                _m("avg_fare", "avg", c.fare),
                _m("avg_tip", "avg", c.tip),
                _m("avg_tip_pct", "avg", c.tip_pct),
            ),
            labels=(payment,),
            order=(("total_trips", False),),
        ),
        Summary(
            "by_pickup_location_top20",
            (c.pickup_loc,),
            (
                n,
                _m("total_revenue", "sum", c.total),
                _m("avg_distance", "avg", c.distance),
                _m("avg_fare", "avg", c.fare),
            ),
            order=(("total_trips", False),),
            limit=TOP_PICKUPS,
        ),
        Summary(
            "by_route_top50",
            (c.pickup_loc, c.dropoff_loc),
            (
                n,
                _m("avg_distance", "avg", c.distance),
                _m("avg_revenue", "avg", c.total),
                _m("avg_duration", "avg", c.duration_min),
            ),
            order=(("total_trips", False),),
            limit=TOP_ROUTES,
        ),
    ]
    return {s.name: s for s in specs}


def silver_summary_spec(c: TripColumns = TRIP) -> Summary:
    """Whole-table averages of the silver layer (no group keys)."""
    return Summary(
        "silver_summary",
        (),
        (
            _m("avg_trip_distance", "avg", c.distance),
            _m("avg_fare", "avg", c.fare),
            _m("avg_trip_duration_min", "avg", c.duration_min),
            _m("avg_tip_pct", "avg", c.tip_pct),
            _m("avg_speed_mph", "avg", c.speed),
        ),
    )

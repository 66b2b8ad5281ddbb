"""Names of the trip columns the operators read.

Every operator takes a ``TripColumns`` so the library works on any trip
schema; the default matches the public yellow-taxi trip-record layout.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TripColumns:
    vendor: str = "VendorID"
    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    passengers: str = "passenger_count"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    tip: str = "tip_amount"
    total: str = "total_amount"
    payment: str = "payment_type"
    pickup_loc: str = "PULocationID"
    dropoff_loc: str = "DOLocationID"

    # derived (silver) columns
    duration_min: str = "trip_duration_min"
    hour: str = "pickup_hour"
    date: str = "pickup_date"
    dayofweek: str = "pickup_dayofweek"
    week: str = "pickup_week"
    tip_pct: str = "tip_percentage"
    speed: str = "speed_mph"


TRIP = TripColumns()

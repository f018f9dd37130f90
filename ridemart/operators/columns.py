"""Which column plays which part, so operators run on any table with these parts."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TripColumns:
    """Column names of a raw or cleaned trip table."""

    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    passengers: str = "passenger_count"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    tip: str = "tip_amount"
    tolls: str = "tolls_amount"
    total: str = "total_amount"
    congestion: str = "congestion_surcharge"
    payment: str = "payment_type"
    rate_code: str = "RatecodeID"
    vendor: str = "VendorID"
    origin: str = "PULocationID"
    destination: str = "DOLocationID"


@dataclass(frozen=True)
class Window:
    """Half-open pickup period of a load, and the number of months it should cover."""

    start: str
    end: str
    months: int

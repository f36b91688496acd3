"""The base tables of one data folder, built lazily as plans."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wayfare.operators import curated, flight, hotel, profiles
from wayfare.session import scratch_path
from wayfare.sinks.tables import overwrite_path
from wayfare.sources import catalogues, fixtures


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _view(self, name: str) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, name)

    @cached_property
    def bookings(self) -> DataFrame:
        return self._view("bookings")

    @cached_property
    def stored_bookings(self) -> DataFrame:
        """The bookings as files of their own, for jobs that read whole bookings more than once: the view's joins run once.

        Where these joins move no rows, the view itself."""
        if not fixtures.has_large_lookup(self.spark, self.sf_dir, "bookings"):
            return self.bookings
        path = scratch_path(self.spark, "bookings")
        overwrite_path(self.bookings, path)
        return self.spark.read.schema(self.bookings.schema).parquet(path)

    @cached_property
    def flights(self) -> DataFrame:
        return self._view("flights")

    @cached_property
    def feedback(self) -> DataFrame:
        return self._view("feedback")

    @cached_property
    def guest_profiles(self) -> DataFrame:
        return self._view("guest_profiles")

    @cached_property
    def packages(self) -> DataFrame:
        return catalogues.packages(self.spark)

    @cached_property
    def guests(self) -> DataFrame:
        return profiles.guests(self.bookings)

    @cached_property
    def hotel_clean(self) -> DataFrame:
        return hotel.clean(self.bookings)

    @cached_property
    def silver(self) -> DataFrame:
        return hotel.silver(self.bookings, self.guests, self.packages)

    @cached_property
    def stays(self) -> DataFrame:
        return hotel.completed(self.silver)

    @cached_property
    def passengers(self) -> DataFrame:
        return profiles.passengers(self.flights)

    @cached_property
    def routes(self) -> DataFrame:
        return profiles.routes(self.flights)

    @cached_property
    def flight_clean(self) -> DataFrame:
        return flight.clean(self.flights)

    @cached_property
    def flown(self) -> DataFrame:
        return flight.silver(self.flights, self.passengers, self.routes)

    @cached_property
    def curated(self) -> DataFrame:
        return curated.bookings(self.bookings)

    @cached_property
    def voices(self) -> DataFrame:
        return curated.feedback(self.feedback)

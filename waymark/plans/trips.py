"""The travel planner's own tables, end to end, on the typed travel schemas.

    capitals, monuments (catalogue files)            hotel / flight topic records
            │                                                  │ decode, score, arrival
            ▼                                                  ▼
    request plan (country × day)      hotelday / flight history (append-only)
            │                                                  │ latest import, date window
            └──────────────► trip report ◄─────────────────────┘

Every country and day is assembled in one job; each side is reduced to one
row per key before it is joined, so the report has exactly one row per plan
row. Monument names are *not* gathered into the report row (a country's list
is unbounded): they form their own numbered table, keyed by country.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.constants import CURRENCY, DAYS_AHEAD, HOME_COUNTRY, STAY_NIGHTS, TOP_K
from waymark import schemas
from waymark.operators import catalog, flights, hotels, latest, reports
from waymark.plans.strategy import materialize
from waymark.streaming.pipeline import decode_flights, decode_hotels


def hotels_from_records(records: DataFrame, nights: int = STAY_NIGHTS, k: int = TOP_K,
                        per_import: bool = True) -> DataFrame:
    """Hotel topic records → scored top-k → the ``hotelday`` table's rows.

    Offers compete within one import of a city and day, so an older import never crowds out a newer one.
    The decoded offers are landed once: the ranges and the scores read the same records, and each is parsed once.
    """
    offers, _ = materialize(decode_hotels(records, nights), "offers")
    return hotels.hotelday_publish(hotels.hotel_top3(offers, k=k, per_import="import_date" if per_import else None))


def best_of_latest(records: DataFrame, nights: int = STAY_NIGHTS, k: int = TOP_K) -> DataFrame:
    """Hotel topic records → landed offers → latest import per city and day → scored top-k as ``hotelday``.

    The decoded offers are landed once, so every later step sees the same records whatever
    arrives in the topic meanwhile. Only offers in the scored currency are published, so the newest
    import is the newest that has one: a later import of other currencies alone hides nothing.
    """
    scored = decode_hotels(records, nights).filter(F.col("currencycode") == CURRENCY)
    offers, _ = materialize(scored, "offers")
    newest = latest.latest_per_key(offers, ["checkin_date", "city_trans"], ts="import_date")
    return hotels.hotelday_publish(hotels.hotel_top3(newest, k=k))


def flights_from_records(records: DataFrame) -> DataFrame:
    """Flight topic records → typed flights with arrival time (the ``flight`` table's rows)."""
    return decode_flights(records).select(*schemas.FLIGHT.fieldNames())


def current_flights(flight_history: DataFrame, start: str | _dt.date | Column,
                    days: int = DAYS_AHEAD) -> DataFrame:
    """Latest import per (date, origin, destination) for travel dates in the window.

    The history is a stored table: it is scanned twice, each time only the window's partitions.
    """
    window = latest.date_window(flight_history, "date", start, days)
    return latest.latest_per_key(window, ["date", "origin", "destination"], ts="import_date")


def current_hotels(hotel_history: DataFrame, start: str | _dt.date | Column,
                   days: int = DAYS_AHEAD) -> DataFrame:
    """Latest import per (check-in, city) for check-in dates in the window."""
    window = latest.date_window(hotel_history, "checkin_date", start, days)
    return latest.latest_per_key(window, ["checkin_date", "city"], ts="import_date")


def _flight_text() -> Column:
    return F.format_string("%.2f EUR with %s, %s to %s, leaves %s, lands %s, stops: %d",
                           "price", "company", "origin", "destination", "time", "arrival_time", "n_connections")


def _hotel_text() -> Column:
    rated = F.when(F.col("rating").isNotNull(), F.format_string(" (%.1f)", "rating")).otherwise("")
    return F.concat(F.format_string("%.2f a night: %s", "price", "name"), rated)


def _monuments_by_country(monuments: DataFrame, aliases: dict[str, list[str]] | None) -> DataFrame:
    if not aliases:
        return monuments
    # monuments filed under another name count for the catalogue country
    reverse = {alias: name for name, names in aliases.items() for alias in names}
    mapping = F.create_map(*[F.lit(x) for pair in reverse.items() for x in pair])
    return monuments.withColumn("country", F.coalesce(mapping[F.col("country")], F.col("country")))


def monument_lines(monuments: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Each country's monuments numbered 1..n by name (W2), one row per monument."""
    mons = _monuments_by_country(monuments, aliases)
    return reports.numbered(mons.select("country", "name", "longitude", "latitude"),
                            ["country"], ["name"], idx_col="line")


def trip_report_table(capitals: DataFrame, monuments: DataFrame, hotelday: DataFrame,
                      flight: DataFrame, start: str | _dt.date, n_days: int = DAYS_AHEAD,
                      home_country: str = HOME_COUNTRY, aliases: dict[str, list[str]] | None = None,
                      k: int = TOP_K) -> DataFrame:
    """One trip row for every catalogue country and each of ``n_days`` days.

    ``hotelday`` / ``flight`` are histories (latest import and date window are
    applied here). The flight shown is the cheapest of the latest import (then
    earliest departure); hotels stand in their scored rank (then price, then name), a hotel that was
    landed twice once.
    """
    plan = catalog.request_plan(capitals.select("country", "capital"), start, n_days, offset=0)
    fl = current_flights(flight, start, n_days)
    best = flights.first_per_key(fl, ["destination", "date"], ["price", "time", "company"])
    flight_side = best.select(F.col("destination").alias("capital"), F.col("date").alias("day"),
                              _flight_text().alias("flight"))
    ht = current_hotels(hotelday, start, n_days).select(
        F.col("city").alias("capital"), F.col("checkin_date").alias("day"), "name", "price", "rating", "rank").distinct()
    hotel_side = reports.top_slots(ht, ["capital", "day"], _hotel_text(),
                                   [F.col("rank").asc_nulls_last(), "price", "name"], k=k)
    mons = _monuments_by_country(monuments, aliases)
    mon_side = mons.groupBy("country").agg(
        F.format_string("%d monuments", F.count(F.lit(1))).alias("monuments"))
    return reports.trip_report(
        plan.join(mon_side, ["country"], "left"), ["capital", "day"], "country", home_country,
        flights=flight_side, hotels=hotel_side, k=k)


def trip_tables(capitals: DataFrame, monuments: DataFrame, hotelday: DataFrame, flight: DataFrame,
                start: str | _dt.date, n_days: int = DAYS_AHEAD, home_country: str = HOME_COUNTRY,
                aliases: dict[str, list[str]] | None = None, k: int = TOP_K
                ) -> tuple[DataFrame, DataFrame]:
    """``(trips, monument_lines)``: the report and each country's numbered monuments."""
    report = trip_report_table(capitals, monuments, hotelday, flight, start, n_days,
                               home_country, aliases, k)
    return report, monument_lines(monuments, aliases)

"""Catalogue operators: request plan, country / day filters, choice lists.

Joins here are against catalogue tables read straight from files; for a file
scan Spark's own size estimate is the file size, so its static broadcast
threshold is a real size check and is left to decide.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.constants import DAYS_AHEAD, REQUEST_DAYS
from waymark.functions.timefn import day_sequence
from waymark.operators.latest import date_window


def request_plan(capitals: DataFrame, start: str | _dt.date | Column, n_days: int = REQUEST_DAYS,
                 offset: int = 1, day_col: str = "day") -> DataFrame:
    """Every catalogue row × each of ``n_days`` days from ``start + offset``.

    A generator (``explode`` of a date sequence) per row, not a join: rows grow by
    exactly ``n_days`` and nothing shuffles.
    """
    return capitals.withColumn(day_col, F.explode(day_sequence(start, n_days, offset)))


def day_options(spark, start: str | _dt.date | Column, n_days: int = DAYS_AHEAD,
                day_col: str = "day") -> DataFrame:
    """The next ``n_days`` days from ``start`` as a one-column table (V4)."""
    return spark.range(1).select(F.explode(day_sequence(start, n_days, 0)).alias(day_col))


def catalog_options(catalog: DataFrame, country_col: str, start: str | _dt.date | Column,
                    n_days: int = DAYS_AHEAD, day_col: str = "day") -> DataFrame:
    """Choice lists: each distinct country paired with each of the next ``n_days`` days."""
    countries = catalog.select(country_col).distinct()
    return countries.withColumn(day_col, F.explode(day_sequence(start, n_days, 0)))


def filter_by_country(data: DataFrame, capitals: DataFrame, country: str, *,
                      capital_col: str = "capital", catalog_country_col: str = "country",
                      destination_col: str = "destination", country_col: str = "country",
                      city_col: str = "city",
                      aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows for one country.

    Precedence: a ``destination`` column matches the country's capitals, else a
    ``country`` column matches the name, else a ``city`` column matches the
    capitals. A table with none of them is returned unchanged. ``aliases``
    (e.g. ``constants.COUNTRY_ALIASES``, off by default) lets a ``country``
    column also match the other names a catalogue uses for the same country.
    """
    def in_capitals(col: str) -> DataFrame:
        chosen = capitals.filter(F.col(catalog_country_col) == F.lit(country)).select(
            F.col(capital_col).alias("_capital"))
        return data.join(chosen, F.col(col) == F.col("_capital"), "left_semi")

    if destination_col in data.columns:
        return in_capitals(destination_col)
    if country_col in data.columns:
        names = [country, *((aliases or {}).get(country, []))]
        return data.filter(F.col(country_col).isin(names))
    if city_col in data.columns:
        return in_capitals(city_col)
    return data


def filter_by_day(data: DataFrame, day: str | _dt.date,
                  columns: Sequence[str] = ("date", "checkin_date")) -> DataFrame:
    """Rows of one day, on the first of ``columns`` the table has."""
    for col in columns:
        if col in data.columns:
            return date_window(data, col, day, 1)
    return data

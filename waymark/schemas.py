"""Declared schemas of the logical tables (all fields nullable)."""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
DATE, TS = T.DateType(), T.TimestampType()

# catalogue file of capitals, in file column order
CAPITAL_FILE = _s(("country", S), ("capital", S), ("airport_code", S), ("dest_id_booking", L))
CAPITAL = CAPITAL_FILE

# catalogue file of monuments, in file column order
MONUMENT_FILE = _s(("ID", I), ("name", S), ("Region", S), ("country", S), ("Geographic Area", S),
                   ("Continent", S), ("latitude", D), ("longitude", D), ("Latitude 2", D),
                   ("Longitude 2", D), ("Latitude 3", D), ("Longitude 3", D))
MONUMENT = _s(("name", S), ("country", S), ("longitude", D), ("latitude", D))

HOTEL_OFFER = _s(("city_trans", S), ("hotel_name", S), ("min_total_price", D), ("currencycode", S),
                 ("longitude", D), ("latitude", D), ("review_score", D), ("checkin_date", DATE),
                 ("import_date", TS))

FLIGHT_OFFER = _s(("time", S), ("duration", I), ("company", S), ("price", D), ("n_connections", I),
                  ("date", DATE), ("import_date", TS), ("origin", S), ("destination", S))

HOTELDAY = _s(("checkin_date", DATE), ("city", S), ("name", S), ("price", D), ("longitude", D),
              ("latitude", D), ("rating", D), ("import_date", TS), ("rank", L))

FLIGHT = _s(("date", DATE), ("time", S), ("arrival_time", S), ("arrival_ts", TS), ("duration", I),
            ("origin", S), ("destination", S), ("company", S), ("price", D), ("n_connections", I),
            ("import_date", TS))

REQUEST_PLAN = _s(("country", S), ("capital", S), ("airport_code", S), ("dest_id_booking", L),
                  ("day", DATE))

TRIP = _s(("country", S), ("day", DATE), ("flight", S), ("hotel_1", S), ("hotel_2", S),
          ("hotel_3", S), ("monuments", S))

"""The hourly consume → transform → write loop as streaming queries.

Each topic becomes one streaming query. Records are decoded with a declared
schema; hotels are ranked per micro-batch (rank is not allowed on a stream, so
the batch operators run inside ``foreachBatch``); flights get their arrival
time as a plain streaming projection. Outputs are written with dynamic
partition overwrite keyed by travel date, run and batch id, so a replayed batch replaces
its own output instead of duplicating it. Bad records never stop a stream: they are in
neither output but in a quarantine stream of their own.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark import schemas
from waymark.constants import STAY_NIGHTS
from waymark.functions.scoring import price_per_night
from waymark.functions.timefn import departure_ts
from waymark.operators.flights import arrival_time
from waymark.operators.hotels import hotel_top3, hotelday_publish
from waymark.sources.sinks import overwrite_partitions
from waymark.sources.topics import split_records


HOTEL_REQUIRED = ["city_trans", "hotel_name", "min_total_price", "checkin_date", "import_date"]
FLIGHT_REQUIRED = ["time", "duration", "date", "import_date", "origin", "destination"]


def split_hotels(records: DataFrame, nights: int = STAY_NIGHTS) -> tuple[DataFrame, DataFrame]:
    """Topic records → (typed hotel offers with ``price_per_day``, rejects)."""
    offers, bad = split_records(records, schemas.HOTEL_OFFER, required=HOTEL_REQUIRED)
    return offers.withColumn("price_per_day", price_per_night("min_total_price", nights)), bad


def split_flights(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topic records → (typed flights with arrival time, rejects); a clock that is none is NULL."""
    flights, bad = split_records(records, schemas.FLIGHT_OFFER, required=FLIGHT_REQUIRED)
    return arrival_time(flights.withColumn("_departure", departure_ts("date", "time")), clock="time",
                        duration="duration", departure_ts="_departure").drop("_departure"), bad


def decode_hotels(records: DataFrame, nights: int = STAY_NIGHTS) -> DataFrame:
    """Topic records → typed hotel offers; the rejects are ``split_hotels``'s second table."""
    return split_hotels(records, nights)[0]


def decode_flights(records: DataFrame) -> DataFrame:
    """Topic records → typed flights (a stateless streaming projection)."""
    return split_flights(records)[0]


def score_hotel_batch(batch: DataFrame, batch_id: int, sink_path: str,
                      per_import: bool = True, run: str = "") -> None:
    """Rank one consumed batch (R3), import by import, and write it as that batch's partitions.

    ``run`` tells the batches of one checkpoint from those of another, which counts from 0 again.
    """
    if batch.isEmpty():  # nothing consumed this round: leave the table as it is
        return
    top = hotel_top3(batch, per_import="import_date" if per_import else None)
    out = hotelday_publish(top).withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)})
    overwrite_partitions(out, sink_path, ["checkin_date", "run", "batch_id"])


def _started(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")).start()


def start_hotel_stream(records: DataFrame, sink_path: str, checkpoint_path: str,
                       nights: int = STAY_NIGHTS, available_now: bool = True) -> StreamingQuery:
    run = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:12]
    return _started(decode_hotels(records, nights).writeStream.option("checkpointLocation", checkpoint_path)
                    .foreachBatch(lambda df, bid: score_hotel_batch(df, bid, sink_path, run=run)), available_now)


def _append(rows: DataFrame, sink_path: str, checkpoint_path: str, available_now: bool,
            by: str | None = None) -> StreamingQuery:
    w = (rows.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint_path).option("path", sink_path))
    return _started(w.partitionBy(by) if by else w, available_now)


def start_flight_stream(records: DataFrame, sink_path: str, checkpoint_path: str,
                        available_now: bool = True) -> StreamingQuery:
    """Flights appended to a table partitioned by travel date, so a look-ahead window prunes it."""
    return _append(decode_flights(records), sink_path, checkpoint_path, available_now, "date")


def start_reject_stream(records: DataFrame, kind: str, sink_path: str, checkpoint_path: str,
                        available_now: bool = True) -> StreamingQuery:
    """The bad records of the ``"hotel"`` or ``"flight"`` topic, kept whole in a quarantine table."""
    split = {"hotel": split_hotels, "flight": split_flights}[kind]
    return _append(split(records)[1], sink_path, checkpoint_path, available_now, "reject_reason")

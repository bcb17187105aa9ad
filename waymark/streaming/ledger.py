"""Imports scored once, without a callback.

The stream only lands raw offers, in a table partitioned by import: a plain file sink, so each
record lands exactly once. A batch step then scores the imports that the ledger does not have yet: it
writes their partitions of the scored table, which a rerun would write again, and adds them to the
ledger last. A step that dies in between leaves its imports out of the ledger, and the next one
scores them again into the same partitions. An import that has received more offers since is scored
anew, since the ledger knows it by its number of offers too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.constants import STAY_NIGHTS, TOP_K
from waymark.operators.hotels import hotel_top3, hotelday_publish
from waymark.plans.strategy import bounded_broadcast, materialize
from waymark.sources.sinks import overwrite_partitions
from waymark.sources.versions import VersionedTable
from waymark.streaming.pipeline import decode_hotels

IMPORT = "import_id"


def import_id(time: str | Column = "import_date") -> Column:
    """An import's partition: its time to the second, as text that a path can hold."""
    return F.date_format(time, "yyyy-MM-dd'T'HH-mm-ss")


def start_offer_landing(records: DataFrame, sink_path: str, checkpoint_path: str, nights: int = STAY_NIGHTS,
                        available_now: bool = True) -> StreamingQuery:
    """Hotel topic records → raw offers, appended to a table partitioned by import."""
    offers = decode_hotels(records, nights).withColumn(IMPORT, import_id())
    writer = (offers.writeStream.format("parquet").outputMode("append").partitionBy(IMPORT)
              .option("checkpointLocation", checkpoint_path).option("path", sink_path))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")).start()


def open_imports(offers: DataFrame, ledger: VersionedTable) -> DataFrame:
    """``(import_id, n_offers)`` of the imports that the ledger lacks or knows with fewer offers (landed)."""
    present = offers.groupBy(IMPORT).agg(F.count(F.lit(1)).alias("n_offers"))
    if ledger.current():
        present = present.join(ledger.read(), [IMPORT, "n_offers"], "left_anti")
    return materialize(present, "open-imports")[0]


def score_open_imports(spark: SparkSession, offers_path: str, scored_path: str, ledger: VersionedTable,
                       k: int = TOP_K) -> int:
    """Score the imports that are open, replace their partitions of the scored table, then close them.

    Returns how many there were. Only their partitions of the offers are read.
    """
    offers = spark.read.parquet(offers_path)
    wanted = open_imports(offers, ledger)
    n = wanted.count()
    if not n:
        return 0
    side, _ = bounded_broadcast(wanted.select(IMPORT), name="open-imports")
    mine, _ = materialize(offers.join(side, IMPORT, "left_semi"), "open-offers")
    top = hotel_top3(mine, k=k, per_import="import_date")
    out = hotelday_publish(top).withColumn(IMPORT, import_id()).repartition(IMPORT)
    overwrite_partitions(out, scored_path, [IMPORT])
    ledger.append(wanted)
    return n

"""Nested API payloads → typed offer rows.

Payloads arrive as JSON text, one response per row, next to the request's own
columns (check-in date, destination, ...), which are carried onto every parsed
row. Parsing is ``from_json`` with a declared schema (PERMISSIVE: a malformed
text gives a NULL struct rather than a failed job), then ``explode`` of the
result array. A response that lacks an expected part goes to a reject output
with a reason instead of being dropped silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.constants import BEST_BUCKET
from waymark.functions.scoring import nan_to_null
from waymark.functions.timefn import clock_of_iso

HOTEL_ITEM = T.StructType([
    T.StructField("city_trans", T.StringType()),
    T.StructField("hotel_name", T.StringType()),
    T.StructField("min_total_price", T.DoubleType()),
    T.StructField("currencycode", T.StringType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("review_score", T.DoubleType()),
])
HOTEL_PAYLOAD = T.StructType([T.StructField("result", T.ArrayType(HOTEL_ITEM))])

FLIGHT_LEG = T.StructType([
    T.StructField("departure", T.StringType()),
    T.StructField("durationInMinutes", T.IntegerType()),
    T.StructField("stopCount", T.IntegerType()),
    T.StructField("carriers", T.StructType([
        T.StructField("marketing", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    ])),
])
FLIGHT_ITEM = T.StructType([
    T.StructField("price", T.StructType([T.StructField("raw", T.DoubleType())])),
    T.StructField("legs", T.ArrayType(FLIGHT_LEG)),
])
FLIGHT_BUCKET = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("items", T.ArrayType(FLIGHT_ITEM)),
])
FLIGHT_PAYLOAD = T.StructType([
    T.StructField("itineraries", T.StructType([
        T.StructField("buckets", T.ArrayType(FLIGHT_BUCKET)),
    ])),
])

REJECT_REASON = "reject_reason"
CORRUPT = "_corrupt_record"


def _parsed(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """``_payload`` struct; text that is not JSON lands in ``_payload._corrupt_record``."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn("_payload", F.from_json(F.col(payload), with_corrupt, opts))


def _unparsable() -> Column:
    return F.col("_payload").isNull() | F.col(f"_payload.{CORRUPT}").isNotNull()


def _carry(df: DataFrame, payload: str) -> list[str]:
    return [c for c in df.columns if c not in (payload, "_payload")]


def parse_hotel_payload(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per hotel in ``result``, request columns carried (S2, P4); NaN review → NULL."""
    p = _parsed(responses, payload, HOTEL_PAYLOAD)
    carry = _carry(p, payload)
    rows = (p.select(*carry, F.explode("_payload.result").alias("_h"))
             .select(*carry, "_h.*"))
    return rows.withColumn("review_score", nan_to_null("review_score"))


def hotel_payload_rejects(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """Responses that are not JSON or have no ``result`` array."""
    p = _parsed(responses, payload, HOTEL_PAYLOAD)
    reason = (F.when(_unparsable(), F.lit("unparsable payload"))
               .when(F.col("_payload.result").isNull(), F.lit("missing result")))
    return (p.withColumn(REJECT_REASON, reason).filter(F.col(REJECT_REASON).isNotNull())
             .drop("_payload"))


def _best_buckets(responses: DataFrame, payload: str, bucket_id: str) -> tuple[DataFrame, list[str]]:
    p = _parsed(responses, payload, FLIGHT_PAYLOAD)
    carry = _carry(p, payload)
    best = F.filter("_payload.itineraries.buckets", lambda b: b["id"] == F.lit(bucket_id))
    b = (p.select(*carry, F.col("_payload").alias("_payload"), F.explode_outer(best).alias("_b")))
    item = F.get(F.col("_b.items"), 0)
    leg = F.get(item["legs"], 0)
    carrier = F.get(leg["carriers"]["marketing"], 0)
    b = b.withColumns({"_item": item, "_leg": leg, "_carrier": carrier})
    return b, carry


def _flight_reason():
    """Why a response gives no flight (NULL: it gives one, or has no chosen bucket)."""
    return (F.when(_unparsable(), F.lit("unparsable payload"))
             .when(F.col("_payload.itineraries.buckets").isNull(), F.lit("missing itineraries"))
             .when(F.col("_b").isNull(), F.lit(None))  # no chosen bucket: not an error
             .when(F.col("_item").isNull(), F.lit("bucket without items"))
             .when(F.col("_leg").isNull(), F.lit("item without legs"))
             .when(F.col("_carrier").isNull(), F.lit("leg without carrier")))


def _leg_parts(bucket: Column) -> tuple[Column, Column, Column]:
    item = F.get(bucket["items"], 0)
    leg = F.get(item["legs"], 0)
    return item, leg, F.get(leg["carriers"]["marketing"], 0)


def _flight_of(bucket: Column) -> Column:
    item, leg, carrier = _leg_parts(bucket)
    return F.struct(clock_of_iso(leg["departure"]).alias("time"),
                    leg["durationInMinutes"].alias("duration"),
                    carrier["name"].alias("company"),
                    item["price"]["raw"].alias("price"),
                    leg["stopCount"].alias("n_connections"))


def _complete(bucket: Column, bucket_id: str) -> Column:
    item, leg, carrier = _leg_parts(bucket)
    return (bucket["id"] == F.lit(bucket_id)) & item.isNotNull() & leg.isNotNull() & carrier.isNotNull()


def parse_flight_payload(responses: DataFrame, payload: str = "payload",
                         bucket_id: str = BEST_BUCKET, dedupe: bool = True) -> DataFrame:
    """The chosen bucket's first item, first leg, first carrier → one flight row (S3).

    Uses ``get`` (NULL when out of range) instead of ``[0]``, which raises on an
    empty array under ANSI mode; responses missing a part are in the rejects.
    Duplicates are removed inside each response (``array_distinct`` before the
    explode), as the original does per response: no shuffle.
    """
    p = _parsed(responses, payload, FLIGHT_PAYLOAD)
    carry = _carry(p, payload)
    chosen = F.filter("_payload.itineraries.buckets", lambda b: _complete(b, bucket_id))
    found = F.transform(chosen, _flight_of)
    if dedupe:
        found = F.array_distinct(found)
    return p.select(F.explode(found).alias("_f"), *carry).select("_f.*", *carry)


def flight_payload_rejects(responses: DataFrame, payload: str = "payload",
                           bucket_id: str = BEST_BUCKET) -> DataFrame:
    """Request columns + ``reject_reason`` for responses that could not give a flight."""
    b, carry = _best_buckets(responses, payload, bucket_id)
    return (b.withColumn(REJECT_REASON, _flight_reason())
             .filter(F.col(REJECT_REASON).isNotNull())
             .select(*carry, REJECT_REASON))


def with_request_columns(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    """Constant request columns (origin, destination, date, ...)."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def hotel_payload_of(rows: DataFrame, page: Sequence[str], item_cols: dict[str, object],
                     page_size: int = 50, gather: int = 100_000) -> DataFrame:
    """Assemble hotel responses from rows: one JSON ``{"result": [...]}`` per page of at most
    ``page_size`` items.

    Rows of one ``page`` key are gathered per slice of ``gather`` consecutive row ids, so no
    list outgrows a slice, even when all rows are copies under one key; a slice's list is cut into pages.
    """
    item = F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in item_cols.items()])
    slice_ = F.floor(F.monotonically_increasing_id() / F.lit(gather)).alias("_slice")
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size("_items") - 1) / page_size).cast("int")),
                        lambda i: F.slice("_items", i * page_size + 1, F.lit(page_size)))
    return (rows.select(*page, item.alias("_item"), slice_)
                .groupBy(*page, "_slice").agg(F.collect_list("_item").alias("_items"))
                .select(*page, F.explode(pages).alias("result"))
                .select(*page, F.to_json(F.struct("result")).alias("payload")))

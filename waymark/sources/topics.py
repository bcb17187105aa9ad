"""Topic records ⇄ typed rows.

A topic record is ``(key, value, timestamp)`` as Spark's Kafka source gives it.
The transforms here work on any DataFrame of that shape, so they run the same
on a batch read, inside a streaming query, or on a table standing in for a
topic. The connector itself (``format("kafka")``) needs its package on the
classpath; ``kafka_source_options`` / ``read_topic`` / ``write_topic`` only
assemble the standard options.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# to_json options: keep NULL fields (a reader expects every key) and keep full
# microsecond precision of timestamps (the default format stops at millis).
JSON_WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
JSON_READ_OPTIONS = {
    "mode": "PERMISSIVE",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "allowNonNumericNumbers": "true",
}


def encode_records(df: DataFrame, key: str | Column | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """Each row → one JSON ``value`` (K1, F14); ``key`` optional."""
    cols = columns or df.columns
    value = F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_WRITE_OPTIONS).alias("value")
    if key is None:
        return df.select(value)
    k = F.col(key) if isinstance(key, str) else key
    return df.select(k.cast("string").alias("key"), value)


def decode_records(records: DataFrame, schema: T.StructType | str, value: str = "value",
                   timestamp: str | None = "timestamp", keep: list[str] | None = None,
                   import_col: str = "import_date") -> DataFrame:
    """JSON ``value`` → typed columns (S4, F14); the record time becomes the import time (P5)."""
    parsed = F.from_json(F.col(value).cast("string"), schema, JSON_READ_OPTIONS)
    keep = [c for c in (keep or []) if c in records.columns]
    fields = (records.sparkSession.createDataFrame([], schema).columns
              if isinstance(schema, str) else schema.fieldNames())
    # the record time is the import time only when the payload does not carry one
    stamp = [F.col(timestamp).alias(import_col)] if timestamp and import_col not in fields else []
    out = records.select(*keep, *stamp, _once(parsed, "_v"))
    return out.select(*keep, "_v.*", *([import_col] if stamp else []))


def _once(value: Column, name: str) -> Column:
    """``value`` as a generated column: filters and projections above it do not evaluate it again.

    The optimizer copies a projected expression into every filter and field access over it, which parses
    one text many times; it does not look through a generator.
    """
    return F.inline(F.array(F.struct(value.alias(name))))


CORRUPT = "_corrupt_record"


def _struct(records: DataFrame, schema: T.StructType | str) -> T.StructType:
    return records.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema


def _probed(records: DataFrame, schema: T.StructType | str, value: str, required: list[str] | None) -> DataFrame:
    """``_v`` (the decoded struct) and ``reject_reason`` (NULL for a good record) beside the record's columns."""
    struct = _struct(records, schema)
    probe = T.StructType(struct.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = dict(JSON_READ_OPTIONS, columnNameOfCorruptRecord=CORRUPT)
    text = F.col(value).cast("string")
    out = records.select("*", _once(F.from_json(text, probe, opts), "_v"))
    reason = (F.when(text.isNull(), F.lit("no value"))
              .when(F.col("_v").isNull() | F.col(f"_v.{CORRUPT}").isNotNull(), F.lit("undecodable")))
    for name in required or []:
        reason = reason.when(F.col(f"_v.{name}").isNull(), F.lit(f"missing {name}"))
    return out.withColumn("reject_reason", reason)


def split_records(records: DataFrame, schema: T.StructType | str, value: str = "value",
                  required: list[str] | None = None, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(decoded, rejects)``: every record is in exactly one of the two.

    A reject is a whole record plus ``reject_reason``: no value, a value that is not JSON or
    does not fit the schema, or a NULL in a ``required`` field.
    """
    struct = _struct(records, schema)
    probed = _probed(records, struct, value, required)
    good = probed.filter(F.col("reject_reason").isNull()).select(
        *[c for c in (keep or []) if c in records.columns], *[F.col(f"_v.`{f}`").alias(f) for f in struct.fieldNames()])
    bad = probed.filter(F.col("reject_reason").isNotNull()).select(*records.columns, "reject_reason")
    return good, bad


def record_outcomes(records: DataFrame, schema: T.StructType | str, value: str = "value",
                    required: list[str] | None = None) -> DataFrame:
    """``(row, record, reject_reason)``, one per record: the decoded columns of a good one, or a bad one whole.

    One plan for both outputs of ``split_records``, for a writer that lands or streams them together.
    """
    struct = _struct(records, schema)
    probed = _probed(records, struct, value, required)
    good, names = F.col("reject_reason").isNull(), struct.fieldNames()
    row = F.struct(*[F.col(f"_v.`{f}`").alias(f) for f in names])
    whole = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    return probed.select(F.when(good, row).alias("row"), F.when(~good, whole).alias("record"), "reject_reason")


def undecodable_records(records: DataFrame, schema: T.StructType | str,
                        value: str = "value") -> DataFrame:
    """Records whose value is there but is not JSON or does not fit the schema (kept whole)."""
    return (_probed(records, schema, value, None).filter(F.col("reject_reason") == "undecodable")
            .select(*records.columns))


def _variant(records: DataFrame, value: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``_v``, the record as a variant: NULL where the value is no JSON object."""
    parsed = records.select(*keep, _once(F.try_parse_json(F.col(value).cast("string")), "_p"))
    return parsed.select(*keep, F.when(F.startswith(F.schema_of_variant("_p"), F.lit("OBJECT")), F.col("_p")).alias("_v"))


def _column_type(seen: str) -> str:
    """The column type for what ``schema_of_variant_agg`` says of a field's values."""
    if seen in ("BIGINT", "BOOLEAN", "DOUBLE"):
        return seen.lower()
    if seen.startswith(("DECIMAL", "FLOAT")):
        return "double"
    return "string"  # text, values of several kinds, and nested ones as their JSON


def drifting_fields(records: DataFrame, value: str = "value", max_fields: int = 10_000) -> dict[str, str]:
    """The fields that any record of the topic has, by name, with a type that fits all their values.

    Nothing is declared: fields are the union over all records (S4, U1). One row per field name comes to the
    driver; more than ``max_fields`` names are an error (names that are really values, not a drifting schema).
    """
    fields = _variant(records, value, []).lateralJoin(
        records.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    seen = (fields.filter(F.col("key").isNotNull()).groupBy("key")
            .agg(F.schema_of_variant_agg("value").alias("kind")).limit(max_fields + 1).collect())
    if len(seen) > max_fields:
        raise ValueError(f"more than {max_fields} field names")
    return {r["key"]: _column_type(r["kind"]) for r in sorted(seen, key=lambda r: r["key"])}


def drifting_records(records: DataFrame, value: str = "value", keep: list[str] | None = None,
                     fields: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a topic whose records have different fields.

    Rows have a column for every field of ``fields`` (by default of ``drifting_fields``), NULL where a record lacks it or
    holds another kind of value. Rejects are whole records whose value is no JSON object. Each text is parsed once
    to find the fields and once per output.
    """
    fields = drifting_fields(records, value) if fields is None else fields
    keep = [c for c in (keep or []) if c in records.columns]
    taken = {c.lower() for c in keep}

    def get(name: str, kind: str) -> Column:
        """The field as a column; names that differ in case alone, which columns may not, are numbered."""
        label, n = name, 1
        while label.lower() in taken:
            n += 1
            label = f"{name}_{n}"
        taken.add(label.lower())
        if "'" in name and '"' in name:  # no path can quote it
            return F.from_json(F.to_json("_v"), "map<string,string>")[name].try_cast(kind).alias(label)
        quote = '"' if "'" in name else "'"
        return F.try_variant_get("_v", f"$[{quote}{name}{quote}]", kind).alias(label)

    rows = _variant(records, value, keep).filter(F.col("_v").isNotNull()).select(*keep, *[get(*f) for f in fields.items()])
    whole = _variant(records, value, records.columns)
    return rows, whole.filter(F.col("_v").isNull()).select(*records.columns)


def record_counts(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Rows per topic (A7) — a partial + final count."""
    return df.groupBy(topic).agg(F.count(F.lit(1)).alias("n_rows"))


def kafka_source_options(bootstrap: str, topic: str, starting: str = "earliest",
                         **extra: str) -> dict[str, str]:
    """Options for ``spark.read/readStream.format('kafka')`` (offsets from earliest).

    Lost offsets fail the query, as is Spark's default; ``failOnDataLoss="false"`` opts out.
    A batch read that is used more than once should pass ``endingOffsets`` (or land its decoded
    records first): "latest" is looked up anew by every job.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    opts.update(extra)
    return opts


def read_topic(spark: SparkSession, bootstrap: str, topic: str, stream: bool = False,
               **extra: str) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**kafka_source_options(bootstrap, topic, **extra)).load()


def write_topic(encoded: DataFrame, bootstrap: str, topic: str) -> None:
    """Batch write of ``(key, value)`` rows to a topic."""
    (encoded.write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())

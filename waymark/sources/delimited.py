"""Delimited catalogue files (S1, F19): ``;`` separated, decimal comma, optional BOM.

The file is read with an all-string schema whose names the header must have, then each column is converted to its declared type with
``try_cast``, numbers after turning the decimal comma into a point. A value
that is present but does not convert is reported by ``conversion_rejects``
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark import schemas
from waymark.constants import CSV_DECIMAL, CSV_SEPARATOR

CORRUPT = "_corrupt_record"
_NUMERIC = (T.DoubleType, T.FloatType, T.DecimalType)


def _as_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def _convert(raw: Column, dtype: T.DataType, decimal: str) -> Column:
    text = F.trim(raw)
    text = F.when(text == F.lit(""), F.lit(None)).otherwise(text)
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, _NUMERIC) and decimal != ".":
        text = F.replace(text, F.lit(decimal), F.lit("."))
    return text.try_cast(dtype)


def read_raw(spark: SparkSession, path: str, schema: T.StructType, sep: str = CSV_SEPARATOR,
             header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """All columns of ``schema`` (in file order) as strings, and ``_corrupt_record``: a row with
    another number of fields, whole.

    The header must name the schema's columns in order; another header fails the read.
    """
    strings = _as_strings(schema).add(CORRUPT, T.StringType())
    return (spark.read.schema(strings).option("enforceSchema", "false")
            .option("header", str(header).lower()).option("sep", sep)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("encoding", encoding).option("mode", "PERMISSIVE").csv(path))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   columns: list[str] | None = None, sep: str = CSV_SEPARATOR,
                   decimal: str = CSV_DECIMAL, header: bool = True) -> DataFrame:
    """Typed table from a delimited file; ``columns`` picks a subset (pruned after read)."""
    raw = read_raw(spark, path, schema, sep, header)
    wanted = columns or schema.fieldNames()
    return raw.select(*[_convert(F.col(c), schema[c].dataType, decimal).alias(c) for c in wanted])


def conversion_rejects(spark: SparkSession, path: str, schema: T.StructType,
                       sep: str = CSV_SEPARATOR, decimal: str = CSV_DECIMAL,
                       header: bool = True) -> DataFrame:
    """Raw rows with another number of fields, or where a non-empty value did not convert to its type."""
    raw = read_raw(spark, path, schema, sep, header)
    bad = F.col(CORRUPT).isNotNull()
    for f in schema.fields:
        present = F.trim(F.col(f.name)) != F.lit("")
        bad = bad | F.coalesce(present & _convert(F.col(f.name), f.dataType, decimal).isNull(), F.lit(False))
    return raw.filter(bad)


def write_delimited(df: DataFrame, path: str, sep: str = CSV_SEPARATOR, decimal: str = CSV_DECIMAL,
                    mode: str = "overwrite") -> None:
    """Write with a header; fractional numbers get the decimal comma."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, _NUMERIC) and decimal != ".":
            c = F.replace(c.cast("string"), F.lit("."), F.lit(decimal))
        cols.append(c.alias(f.name))
    df.select(*cols).write.mode(mode).option("header", "true").option("sep", sep).csv(path)


def read_capitals(spark: SparkSession, path: str) -> DataFrame:
    """Capital catalogue: country, capital, airport code, hotel-site destination id."""
    return read_delimited(spark, path, schemas.CAPITAL_FILE)


def read_monuments(spark: SparkSession, path: str) -> DataFrame:
    """Monument catalogue, the loaded subset: name, country, longitude, latitude."""
    return read_delimited(spark, path, schemas.MONUMENT_FILE, columns=schemas.MONUMENT.fieldNames())

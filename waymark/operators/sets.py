"""Set operations (U1, U2) and the map-point table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Append rows by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def map_points(layers: dict[str, tuple[DataFrame, str, str, str]], layer_col: str = "layer") -> DataFrame:
    """One point table from several layers.

    ``layers`` maps a layer name to ``(frame, name_col, lon_col, lat_col)``; every
    layer is projected to ``(name, lon, lat, layer)`` — always longitude first —
    and rows without a name or coordinate are dropped (P12).
    """
    parts = []
    for layer, (df, name, lon, lat) in layers.items():
        parts.append(df.select(F.col(name).cast("string").alias("name"),
                               F.col(lon).cast("double").alias("lon"),
                               F.col(lat).cast("double").alias("lat"),
                               F.lit(layer).alias(layer_col))
                       .na.drop(subset=["name", "lon", "lat"]))
    return union_by_name(*parts)

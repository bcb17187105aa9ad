"""Helpers shared by the training-data operators.

Every operator takes a DataFrame and the names of the columns it reads, and selects
only those, so extra columns (also ones whose names clash with its outputs) never
reach its plan. Intermediate tables are written under ``spark.checkpoint.dir``: that
cuts lineage in storage every executor sees, so a lost executor costs one task.
"""

from __future__ import annotations

import math
import tempfile
import weakref
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

from waymark.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_shipped: weakref.WeakSet = weakref.WeakSet()  # sessions that have the package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let the executors' Python import this package, however the driver came by it.

    The package's files go out as one archive through Spark's own file distribution, once per
    session; where the package is on the executors' path already, that changes nothing.
    Called before a Python function is handed to Spark.
    """
    home = Path(__file__).resolve().parents[1]
    if spark in _shipped or not home.is_dir():  # already an archive: sent by whoever put it there
        return
    _shipped.add(spark)
    archive = Path(tempfile.mkdtemp(prefix="waymark-ship-")) / "waymark-package.zip"  # on the driver only
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    if is_remote():
        spark.addArtifacts(str(archive), pyfile=True)
    else:
        spark.sparkContext.addPyFile(str(archive))


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back with its known schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_with(df: DataFrame, name: str, **stats: Column) -> tuple[DataFrame, dict]:
    """``land`` plus aggregates observed during the same write."""
    seen = Observation(f"llm_{name}")
    out = land(df.observe(seen, *[c.alias(k) for k, c in stats.items()]), name)
    return out, dict(seen.get)


def ascii_lower(col: Column) -> Column:
    """``col`` with A-Z lower-cased and every other character left as it is.

    ``lower`` does that for texts of ASCII alone, at a fraction of what ``translate`` costs.
    """
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def text_hash(col: Column) -> Column:
    """64-bit content hash of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(col, F.lit("")))


def doc_key(id_col: str, text_col: str) -> Column:
    """``doc``: what tells documents apart, as a struct of id and text hash.

    Rows may share an id, and ids may be null: a struct joins on null fields as on others.
    """
    return F.struct(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("th")).alias("doc")


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """How many partitions hold ``rows`` rows at ``per_part`` each."""
    return max(least, math.ceil(rows / per_part))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column laid end to end and the offsets of its rows (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, off - off[0]


def blocks(col: pa.Array, most: int = 1 << 20):
    """Cut the rows of a string column into slices of about ``most`` bytes: yields (first row, end row)."""
    lengths = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, first = 0, 0
    for i, n in enumerate(lengths):
        if i > first and total + n > most:  # also after rows without bytes: a long row is alone
            yield first, i
            first, total = i, 0
        total += int(n)
    if len(lengths) > first:
        yield first, len(lengths)

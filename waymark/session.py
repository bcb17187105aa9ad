"""Session helpers: building a session for tests/bench and finding shared scratch space.

Library code never picks a machine-local folder on its own: every path it writes
(checkpoints, staged tables, stream checkpoints) lives under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is unset (a
bare local test session) do we set one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.utils import is_remote

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "waymark", driver_memory: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark (not used by library code)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root; a private one is set only if unset, and only for a local master.

    On a cluster an unset ``spark.checkpoint.dir`` is an error: a folder of this machine's
    own would be invisible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="waymark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not is_remote() and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)  # the RDD checkpoint folder, too
    return root


_open_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "waymark", f"{name}-{uuid.uuid4().hex[:12]}")
    for scope in _open_scopes:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, on leaving, every scratch table made inside.

    Results that read such tables must be written (or collected) before the scope ends.
    """
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)

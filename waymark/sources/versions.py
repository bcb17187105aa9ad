"""Stored tables whose content is swapped whole (K2) and rewritten by partition (K4).

A table is a folder of loads and a folder of numbered manifests. Every write goes to a load of its own,
``data/load=<id>/[column=value/]``, so nothing that a reader sees is ever touched. A manifest names the
directories that make up one version; publishing it is one rename that fails if the number is taken.
A reader is pinned to the directories of the version it began with, also while its own result is
being written back. A writer that dies leaves files no manifest names; two writers of one version
cannot both publish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.session import scratch_path
from waymark.sources.sinks import conform

_LOAD = "load"


class PublishConflict(RuntimeError):
    """Another writer published the version that this one meant to."""


class VersionedTable:
    """A parquet table under ``root``, optionally partitioned, with versions 1, 2, ..."""

    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), list(partition_by)
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # --- files, through the file system that the root names

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _names(self, pattern: str) -> list[str]:
        """Paths under the root that match, relative to it."""
        where = self._path(pattern)
        base = self._path().toUri().getPath() + "/"
        found = where.getFileSystem(self._conf).globStatus(where) or []
        return sorted(f.getPath().toUri().getPath().removeprefix(base) for f in found)

    def _text(self, name: str) -> str:
        where = self._path(name)
        stream = where.getFileSystem(self._conf).open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # --- versions

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        return [int(n.rsplit("/", 1)[1]) for n in self._names("manifest/[0-9]*")]

    def current(self) -> int:
        """The newest version; 0 if nothing has been published."""
        return max(self.versions(), default=0)

    def _manifest(self, version: int) -> dict:
        if not version:
            raise ValueError(f"no version of {self.root} has been published")
        return json.loads(self._text(f"manifest/{version:08d}"))

    def note(self, name: str, version: int | None = None):
        """What the writer of a version noted under ``name`` (None if nothing)."""
        version = self.current() if version is None else version
        return self._manifest(version)["notes"].get(name) if version else None

    def _publish(self, version: int, manifest: dict) -> None:
        """Make ``version`` the newest, unless there is one of that number."""
        draft, final = self._path(f"manifest/.draft-{uuid.uuid4().hex}"), self._path(f"manifest/{version:08d}")
        out = draft.getFileSystem(self._conf).create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        fs = self._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
        try:
            fs.FileContext.getFileContext(final.toUri(), self._conf).rename(draft, final, options)
        except Exception as taken:
            if not final.getFileSystem(self._conf).exists(final):
                raise
            draft.getFileSystem(self._conf).delete(draft, False)
            raise PublishConflict(f"version {version} of {self.root} is there already") from taken

    # --- reading

    def _read(self, directories: Sequence[str], schema: T.StructType) -> DataFrame:
        if not directories:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField(_LOAD, T.StringType())])
        return (self.spark.read.schema(whole).option("basePath", f"{self.root}/data")
                .parquet(*[f"{self.root}/{d}" for d in directories]).select(*schema.fieldNames()))

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self._manifest(self.current() if version is None else version)["schema"])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (default: the newest now), whatever is published later."""
        manifest = self._manifest(self.current() if version is None else version)
        return self._read(manifest["directories"], T.StructType.fromJson(manifest["schema"]))

    # --- writing

    def _load(self, df: DataFrame) -> list[str]:
        """Write ``df`` as a load; the directories it fills."""
        load = f"data/{_LOAD}={uuid.uuid4().hex[:12]}"
        writer = df.write
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/{load}")
        return self._names("/".join([load, *("*=*" for _ in self.partition_by)])) if self.partition_by else [load]

    def replace(self, df: DataFrame, **notes) -> int:
        """Publish ``df`` as the whole table, also where ``df`` reads this table. Returns the version."""
        version = self.current() + 1  # before the write: a version published meanwhile is a conflict
        directories = self._load(df)
        self._publish(version, {"schema": df.schema.jsonValue(), "directories": directories, "notes": notes})
        return version

    def append(self, df: DataFrame, **notes) -> int:
        """Publish the table with the rows of ``df`` added; the first append makes it. Returns the version."""
        before = self.current()
        if not before:
            return self.replace(df, **notes)
        manifest = self._manifest(before)
        added = self._load(conform(df, T.StructType.fromJson(manifest["schema"])))
        self._publish(before + 1, manifest | {"directories": manifest["directories"] + added,
                                              "notes": manifest["notes"] | notes})
        return before + 1

    def rewrite(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], **notes) -> int:
        """Publish a version in which the partitions of ``batch`` hold ``merge(their rows, batch)``.

        ``batch`` is written once, partitioned as the table is; only directories of its partitions are read, and
        all others are taken over by name. ``merge`` must not move rows to other partitions.
        """
        before = self.current()
        manifest = self._manifest(before)
        schema = T.StructType.fromJson(manifest["schema"])
        staged = VersionedTable(self.spark, scratch_path(self.spark, "staged-batch"), self.partition_by)
        staged.replace(conform(batch, schema))
        inside = {d.split("/", 2)[2] if self.partition_by else "" for d in staged._manifest(1)["directories"]}
        touched, rest = [], []
        for d in manifest["directories"]:
            own = d.split("/", 2)[2] if self.partition_by else ""
            (touched if own in inside else rest).append(d)
        merged = merge(self._read(touched, schema), staged.read()).select(*schema.fieldNames())
        filled = self._load(merged)
        stray = {d.split("/", 2)[2] for d in filled} - inside if self.partition_by else set()
        if stray:
            raise ValueError(f"the merge put rows into partitions that the batch does not have: {sorted(stray)[:5]}")
        self._publish(before + 1, {"schema": manifest["schema"], "directories": rest + filled,
                                   "notes": manifest["notes"] | notes})
        return before + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` versions and the loads that none of those names.

        Run it when no writer is at work: a load that is not published yet is named by none either.
        """
        versions = self.versions()
        kept = versions[-keep:]
        named = {d.split("/")[1] for v in kept for d in self._manifest(v)["directories"]}
        gone = [f"manifest/{v:08d}" for v in versions if v not in kept]
        gone += [d for d in self._names(f"data/{_LOAD}=*") if d.split("/")[1] not in named]
        for name in gone:
            where = self._path(name)
            where.getFileSystem(self._conf).delete(where, True)
        return gone


def upsert(table: VersionedTable, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` enter ``table`` as a primary key has it: one row per key, the batch's before the table's.

    Of rows that repeat a key the one with the largest ``order_by`` counts, then the largest by its other columns.
    Partition columns must be among the keys, so a key is looked for in its own partition alone. Returns the rows
    that no key lets in: those with a NULL in it, as they came.
    """
    keys = list(keys)
    outside = [c for c in table.partition_by if c not in keys]
    if outside:
        raise ValueError(f"partition columns must be part of the key: {outside}")
    rest = [*order_by, *[c for c in batch.columns if c not in keys and c not in order_by]]
    keyed = F.lit(True)
    for c in keys:
        keyed = keyed & F.col(c).isNotNull()
    one = (batch.filter(keyed).groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
           .select(*keys, "_row.*"))  # combined before the shuffle, so a key of very many rows is none
    table.rewrite(one, lambda old, new: old.join(new.select(*keys), keys, "left_anti").unionByName(new))
    return batch.filter(~keyed)

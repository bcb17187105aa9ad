"""Counts taken on the way (A7): what went in, what came out, kept per run.

The numbers are observed while the rows are written, by ``DataFrame.observe`` in a batch and by the
query's own progress in a stream, so counting reads nothing a second time. Every run adds its rows to an
audit table; ``unbalanced`` names the runs whose records are neither rows nor rejects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.session import scratch_path
from waymark.sources.topics import record_outcomes
from waymark.sources.versions import VersionedTable

AUDIT_SCHEMA = "run string, topic string, step long, n_in long, n_out long, n_rejected long"
METRICS = "audit"


def outcome_counts(reason: str = "reject_reason") -> dict[str, Column]:
    """``n_in``, ``n_out`` and ``n_rejected`` of rows that carry a reject reason (NULL for a good one)."""
    return {"n_in": F.count(F.lit(1)), "n_out": F.count(F.when(F.col(reason).isNull(), 1)), "n_rejected": F.count(reason)}


def append_audit(spark: SparkSession, table: VersionedTable, rows: Sequence[tuple]) -> None:
    """Add rows of ``AUDIT_SCHEMA`` to the audit table."""
    table.append(spark.createDataFrame(list(rows), AUDIT_SCHEMA).coalesce(1))


def audited_split(records: DataFrame, schema, run: str, topic: str, table: VersionedTable, **options
                  ) -> tuple[DataFrame, DataFrame]:
    """``split_records`` with its counts in the audit table: each record is parsed once, landed, and counted in that write."""
    spark, seen = records.sparkSession, Observation(f"audit_{topic}")
    outcomes = observed(record_outcomes(records, schema, **options), seen)
    path = scratch_path(spark, f"{topic}-outcomes")
    outcomes.write.parquet(path)
    landed = spark.read.schema(outcomes.schema).parquet(path)
    append_audit(spark, table, [(run, topic, 0, *(int(seen.get[c]) for c in outcome_counts()))])
    good = landed.filter(F.col("reject_reason").isNull()).select("row.*")
    bad = landed.filter(F.col("reject_reason").isNotNull()).select("record.*", "reject_reason")
    return good, bad


def observed(outcomes: DataFrame, by: Observation | str = METRICS) -> DataFrame:
    """Outcomes that report their counts when they are written: to an observation, or in a stream's progress."""
    return outcomes.observe(by, *[c.alias(name) for name, c in outcome_counts().items()])


def stream_audit(query: StreamingQuery, run: str, topic: str) -> list[tuple]:
    """Audit rows of the micro-batches that a finished query of ``observed`` rows reports."""
    out = []
    for p in query.recentProgress:
        seen = p.observedMetrics.get(METRICS)
        if seen is not None and p.numInputRows:
            out.append((run, topic, p.batchId, seen.n_in, seen.n_out, seen.n_rejected))
    return out


def unbalanced(audit: DataFrame) -> DataFrame:
    """Audit rows where what went in is not what came out and what was set aside."""
    return audit.filter(F.col("n_in") != F.col("n_out") + F.col("n_rejected"))

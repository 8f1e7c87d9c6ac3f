"""Streaming forms of the batch operators. Functions take and return streaming
DataFrames; `run_available` drives one to the end of its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdictlake.functions.redaction import redact_pii, redact_pii_json, redact_secrets, redact_secrets_json
from verdictlake.operators.runs import event_line
from verdictlake.session import work_path

TERMINAL = ["succeeded", "failed"]  # fixed values


def stream_event_feed(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each (run, seq) once, rendered as a line. The checkpoint is the cursor."""
    return (events.withWatermark("created_at", delay)
            .dropDuplicatesWithinWatermark(["run_id", "seq"])
            .select("run_id", "seq", "created_at", event_line(F.col("stage"), F.col("message"), F.col("data")).alias("line")))


def idempotent_turns(turns: DataFrame, delay: str = "1 hour") -> DataFrame:
    """A re-sent turn never counts twice."""
    return (turns.withWatermark("recorded_at", delay)
            .dropDuplicatesWithinWatermark(["rollout_id", "turn_idx"]))


def stream_redaction(turns: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Secrets and personal data out of live turns, before any sink."""
    return turns.withColumn("content", redact_pii(redact_secrets(F.col("content"), extra)))


def stream_event_redaction(events: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The same for the payloads of live tool events: secrets first, keys too,
    then personal data. A payload that is no JSON becomes NULL, never raw text."""
    payloads = [c for c in ("input", "output") if c in events.columns]

    def listed(done: Column | list[Column]) -> list[Column]:
        return done if isinstance(done, list) else [done]
    scrubbed = events.withColumns(dict(zip(payloads, listed(redact_secrets_json(*[F.col(c) for c in payloads], extra=extra)))))
    return scrubbed.withColumns(dict(zip(payloads, listed(redact_pii_json(*[F.col(c) for c in payloads])))))


def run_available(stream: DataFrame, spark: SparkSession, name: str, mode: str = "append") -> str:
    """Process all available input and return the folder of the result.

    Append streams use the file sink, whose log makes output exactly-once.
    Update streams write each micro-batch under its number and overwrite it
    when a batch is replayed, which is idempotent.
    """
    folder = work_path(spark, name)
    out, log = f"{folder}/out", f"{folder}/log"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", log).trigger(availableNow=True)
    if mode == "append":
        started = writer.format("parquet").option("path", out).option("compression", "zstd").start()
    else:
        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        started = writer.foreachBatch(keep).start()
    started.awaitTermination()
    return out


def latest_update(spark: SparkSession, out: str, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Last value of every key of an update stream's result folder; ``within``
    orders the rows that one micro-batch may have of a key."""
    rows = spark.read.parquet(out)
    others = [c for c in rows.columns if c not in (*keys, "batch")]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct("batch", *within)).alias("row"))
            .select(*keys, "row.*"))


def summed(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Totals per key of a stream that hands out counts as they come in."""
    rows = spark.read.parquet(out)
    counts = [c for c, kind in rows.dtypes if kind == "bigint" and c not in keys]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])

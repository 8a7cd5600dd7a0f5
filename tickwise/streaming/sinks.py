"""Stream sinks (K2, K3) and a run-to-completion helper writing Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickwise.session import scratch_path


def kafka_writer(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """K2: ``key``/``value`` string columns to a topic, checkpointed."""
    return (df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
            .writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))


def console_writer(df: DataFrame, trigger: str = "2 seconds",
                   output_mode: str = "append") -> DataStreamWriter:
    """K3 + T6: untruncated console output on a processing-time trigger."""
    return (df.writeStream.format("console").option("truncate", False)
            .outputMode(output_mode).trigger(processingTime=trigger))


def run_to_parquet(df: DataFrame, name: str, checkpoint: str | None = None,
                   out: str | None = None, partition_by: list[str] | None = None,
                   counts: dict[str, int] | None = None,
                   conf: dict[str, str] | None = None) -> DataFrame:
    """Run a streaming query over everything available (``availableNow``),
    appending to Parquet under the shared checkpoint folder, and return the
    written table as a batch DataFrame. Restarting with the same
    ``checkpoint`` resumes where the last run stopped (T8). ``counts``, if given, is
    filled with the observed metrics of the run (:func:`observed`)."""
    spark: SparkSession = df.sparkSession
    run = uuid.uuid4().hex[:12]
    checkpoint = checkpoint or scratch_path(spark, f"tickwise-streams/{name}-{run}/_checkpoint")
    out = out or scratch_path(spark, f"tickwise-streams/{name}-{run}/data")
    w = (df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = start_to_end(w, spark, conf)
    if counts is not None:
        counts.update(observed(q))
    return spark.read.schema(df.schema).parquet(out)


def start_to_end(writer: DataStreamWriter, spark: SparkSession,
                 conf: dict[str, str] | None = None) -> StreamingQuery:
    """Run a query until all available input is done. State partitions are fixed when
    it first starts (and then kept in its checkpoint): they are sized to the
    cluster's cores, not a fixed default. ``conf`` holds further settings to start with."""
    conf = {"spark.sql.shuffle.partitions": str(max(1, spark.sparkContext.defaultParallelism)), **(conf or {})}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        q = writer.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    return q


def run_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``fn(batch, epoch)`` over everything available, resuming at ``checkpoint``."""
    return start_to_end(df.writeStream.foreachBatch(fn).outputMode("append")
                        .option("checkpointLocation", checkpoint).trigger(availableNow=True), df.sparkSession)


def observed(query: StreamingQuery) -> dict[str, int]:
    """The metrics that a query observed, summed over its micro-batches, as
    ``metric.column`` (Spark keeps the last ``numRecentProgressUpdates`` batches: a
    longer run is read as it goes)."""
    out: dict[str, int] = {}
    for p in query.recentProgress:
        for name, row in (p.observedMetrics or {}).items():
            for column, n in row.asDict().items():
                out[f"{name}.{column}"] = out.get(f"{name}.{column}", 0) + int(n or 0)
    return out


def epoch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that is exactly-once: an epoch owns a folder and
    replaces it as a whole, so one that was written but not committed before a
    failure is written over when the query resumes."""
    def run(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return run

"""Scoring minutes as they close (T9), with a bounded tail.

Each micro-batch of closed minutes needs the minutes before it only as far as one
window reaches. They are kept as a tail table: the newest ``WINDOW`` complete
minutes, one file, written anew for every epoch. A batch reads that file and its
own rows, never the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import model, samples
from tickwise.session import delete_path, is_written


def _tail(spark, tail_path: str, epoch: int) -> DataFrame | None:
    path = f"{tail_path}/epoch={epoch}"
    return spark.read.parquet(path) if is_written(spark, path) else None


def predict_each_batch(feature_path: str, prediction_path: str, model_path: str,
                       tail_path: str | None = None, every_window: bool = False,
                       score: Callable[..., DataFrame] = model.score) -> Callable:
    """A ``foreachBatch`` function over closed minutes, in time order.

    An epoch writes its minutes to the feature table (days below the epoch), the
    new tail and its predictions: of the newest window, or with ``every_window`` of
    all windows that end in a minute of the epoch. All three are folders of the
    epoch's own, replaced as a whole, and an epoch reads the tail of the one before
    it, so a replayed epoch gives the same result. Older tails are removed.
    """
    tail_path = tail_path or f"{feature_path}-tail"

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        mine = f"{feature_path}/epoch={epoch_id}"
        (batch.withColumn("day", F.to_date("Timestamp_Rounded")).write.mode("overwrite")
         .partitionBy("day").parquet(mine))
        new = samples.model_input(spark.read.schema(batch.schema).parquet(mine))
        old = _tail(spark, tail_path, epoch_id - 1)
        rows = new if old is None else old.unionByName(new)
        (rows.orderBy(F.desc("ts")).limit(samples.WINDOW).coalesce(1)
         .write.mode("overwrite").parquet(f"{tail_path}/epoch={epoch_id}"))
        if every_window:
            ready = samples.windows(rows)
            if old is not None:
                done = old.agg(F.max("ts")).first()[0]
                ready = ready if done is None else ready.where(F.col("end_ts") > F.lit(done))
        else:
            ready = samples.latest_sample(_tail(spark, tail_path, epoch_id))
        scored = score(model.load(model_path), ready.withColumn("split", F.lit("live")))
        scored.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite") \
            .parquet(f"{prediction_path}/epoch={epoch_id}")
        delete_path(spark, f"{tail_path}/epoch={epoch_id - 2}")
    return run

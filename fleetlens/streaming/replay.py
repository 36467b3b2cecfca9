"""Run a streaming operator over a stored table, slice by slice in time order, and read the result back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.session import scratch_dir
from fleetlens.streaming.timelines import write_batch


def replay(
    rows: DataFrame, operator: Callable[[DataFrame], DataFrame], label: str, order: str, slices: int = 2
) -> DataFrame:
    """What ``operator`` emits, with the number of the micro-batch as ``batch``.

    ``order`` is a time column. The rows are cut into ``slices`` of about equal size by its quantiles (rows without a time come
    first); each slice is appended to the stream's folder and run to its end on one checkpoint, so state is carried from slice to slice.
    To work through long history use the batch operators; a stream follows what is new.
    """
    spark = rows.sparkSession
    base = scratch_dir(spark, label)
    rows.write.parquet(f"{base}/all")
    stored = spark.read.schema(rows.schema).parquet(f"{base}/all")
    # An empty slice makes the stream's folder exist before the stream is defined on it.
    stored.filter(F.lit(False)).write.parquet(f"{base}/in")
    result = operator(spark.readStream.schema(rows.schema).parquet(f"{base}/in"))
    spark.createDataFrame([], result.schema).write.parquet(f"{base}/out/batch=-1")
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted(set(stored.agg(F.percentile_approx(order, shares)).first()[0] or [])) if shares else []
    place = sum((F.coalesce(F.col(order) > cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    for i in range(len(cuts) + 1):
        part = stored.filter(place == i)
        part.write.mode("append").parquet(f"{base}/in")
        (
            result.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).foreachBatch(write_batch(f"{base}/out")).start().awaitTermination()
        )
    return spark.read.parquet(f"{base}/out")

"""Dead-letter alarm (T4): failures per 300 s tumbling window, alarm when > 0.

The batch form is a ``groupBy(window)``; the stream form is the same
aggregate on a file stream with a watermark. Both count per window with
partial aggregation, so a burst of failures in one window is still one
row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Evaluation period 300 s, threshold: sum > 0.
PERIOD = "5 minutes"
THRESHOLD = 0

ALARM_COLUMNS = ["window_start", "window_end", "n_failures", "alarm"]


def _as_timestamp(col: str) -> F.Column:
    # TIMESTAMP_NTZ cannot carry a watermark; with a UTC session the cast
    # keeps the same wall-clock values.
    return F.col(col).cast(T.TimestampType())


def failure_windows(failures: DataFrame, ts_col: str = "ts", period: str = PERIOD) -> DataFrame:
    """Batch: one row per non-empty window with its failure count and alarm flag.

    Windows are taken on the column as it is (a TIMESTAMP_NTZ stays in wall
    time), so the result does not depend on the session time zone.
    """
    w = failures.select(F.window(F.col(ts_col), period).alias("w"))
    agg = w.groupBy("w").agg(F.count(F.lit(1)).alias("n_failures"))
    return _finish(agg)


def alarm_transitions(windows: DataFrame, period: str = PERIOD, threshold: int = THRESHOLD) -> DataFrame:
    """Changes of the alarm's state: (at, state), ``ALARM`` at the start of
    the first window over the threshold after a window that was not, ``OK``
    at the end of the last one. Windows that are not there count as 0.

    Nothing is filled in and no task sees all windows: a run of windows over
    the threshold begins where no such window ends and ends where none
    begins, which two anti joins on the boundary tell. ``windows`` is the
    output of ``failure_windows``.
    """
    hot = windows.filter(F.col("n_failures") > threshold).select("window_start", "window_end")
    starts = hot.select(F.col("window_start").alias("at"))
    ends = hot.select(F.col("window_end").alias("at"))
    return (starts.join(ends, "at", "left_anti").withColumn("state", F.lit("ALARM"))
            .unionByName(ends.join(starts, "at", "left_anti").withColumn("state", F.lit("OK"))))


def alarm_states(windows: DataFrame, first: str, last: str, period: str = PERIOD,
                 threshold: int = THRESHOLD) -> DataFrame:
    """The gap-filled series from ``first`` up to (not including) ``last``:
    one row per window with its failures (0 where there are none) and state."""
    spark = windows.sparkSession
    series = spark.sql(f"select explode(sequence(timestamp_ntz '{first}', timestamp_ntz '{last}' - interval {period}, "
                       f"interval {period})) as window_start")
    filled = series.join(windows.select("window_start", "n_failures"), "window_start", "left")
    n = F.coalesce("n_failures", F.lit(0).cast("bigint"))
    return filled.select("window_start", (F.col("window_start") + F.expr(f"interval {period}")).alias("window_end"),
                         n.alias("n_failures"), F.when(n > threshold, "ALARM").otherwise("OK").alias("state"))


def _finish(agg: DataFrame) -> DataFrame:
    return agg.select(F.col("w.start").cast(T.TimestampNTZType()).alias("window_start"),
                      F.col("w.end").cast(T.TimestampNTZType()).alias("window_end"),
                      F.col("n_failures"),
                      (F.col("n_failures") > THRESHOLD).alias("alarm"))


def stream_failure_windows(stream: DataFrame, ts_col: str = "ts", period: str = PERIOD,
                           watermark: str = "10 minutes") -> DataFrame:
    """Streaming: the same windows over a stream with a watermark."""
    s = stream.withColumn("_ts", _as_timestamp(ts_col)).withWatermark("_ts", watermark)
    agg = s.groupBy(F.window("_ts", period).alias("w")).agg(F.count(F.lit(1)).alias("n_failures"))
    return _finish(agg)


def start_stream_alarm(spark: SparkSession, source_dir: str, file_glob: str, schema: T.StructType | str,
                       out_path: str, checkpoint: str, failure_filter: F.Column, ts_col: str = "ts",
                       output_mode: str = "append", available_now: bool = True,
                       watermark: str = "10 minutes"):
    """Start the alarm stream over parquet files; returns the StreamingQuery.

    ``append`` (default): a window is written once, when the watermark has
    passed its end; state is evicted, so a continuous stream keeps bounded
    state. The file sink appends exactly once per window.
    ``complete``: every micro-batch rewrites the whole window table (state
    keeps one row per window ever seen), so a bounded run reports the last,
    still open window too; for bounded ``availableNow`` runs only.
    """
    src = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
           .parquet(source_dir).filter(failure_filter))
    windows = stream_failure_windows(src, ts_col, watermark=watermark)
    w = windows.writeStream.option("checkpointLocation", checkpoint)
    if output_mode == "append":
        w = w.outputMode("append").format("parquet").option("path", out_path)
    else:
        def sink(batch: DataFrame, _batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(out_path)
        w = w.outputMode("complete").foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_stream_alarm(spark: SparkSession, source_dir: str, file_glob: str, schema: T.StructType | str,
                     out_path: str, checkpoint: str, failure_filter: F.Column,
                     ts_col: str = "ts", timeout_s: int | None = None, output_mode: str = "complete") -> DataFrame:
    """Run the alarm as an ``availableNow`` stream and read the windows back."""
    q = start_stream_alarm(spark, source_dir, file_glob, schema, out_path, checkpoint, failure_filter,
                           ts_col, output_mode, True)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("alarm stream did not finish")
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(out_path)

"""Incremental statistics and continuous preparation on a stream of rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.operators.scaling import fill_statistics, finite_statistics, merge_statistics
from evenkeel.session import new_place


def open_stream(spark: SparkSession, folder: str, pattern: str, max_files: int | None = None) -> DataFrame:
    """A stream over the Parquet files of a folder whose names match ``pattern``."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def replay(parts: Sequence[DataFrame], folder: str | None = None) -> str:
    """Write ``parts`` one after the other, a file each; a stream over the folder meets them in that order."""
    spark = parts[0].sparkSession
    folder = folder or _run_folder(spark)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def _run_folder(spark: SparkSession) -> str:
    return new_place(spark, "stream")


def streamed_statistics(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], variables: Sequence[str],
                        defaults: Mapping[str, float] | None = None, folder: str | None = None) -> DataFrame:
    """Scaling statistics of all rows seen so far.

    Every micro-batch writes its own statistics under its batch number, so a repeated
    batch replaces itself; the parts are then merged like any others.
    """
    spark = stream.sparkSession
    folder = folder or _run_folder(spark)

    def store(batch: DataFrame, number: int) -> None:
        # a batch whose values are all missing still counts its rows
        part = finite_statistics(prepare(batch), variables).filter(F.col("n_rows") > 0)
        part.na.fill(0.0, ["shift", "scale"]).write.mode("overwrite").parquet(f"{folder}/parts/batch={number}")

    run = (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return fill_statistics(merge_statistics(spark.read.parquet(f"{folder}/parts"), totals=["n_rows"]), defaults)


def prepared_stream(stream: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Row-wise steps (cuts, class label, split tag, scaling, score) applied to a stream."""
    for step in steps:
        stream = step(stream)
    return stream


def run_to_table(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Append everything available to Parquet, then read it back."""
    spark = stream.sparkSession
    folder = folder or _run_folder(spark)
    run = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")



def drift_monitor(
    stream: DataFrame, time: str, width: str, delay: str, groups: Sequence[str], passed: Column, folder: str | None = None,
) -> DataFrame:
    """``(window_start, window_end, *groups, n, n_passed, pass_fraction)`` per time window of ``width``.

    State is kept until the latest time seen is ``delay`` past a window's end; rows of such a window
    that come later are dropped. Every micro-batch writes the windows it changed under its number, so
    that a repeated batch replaces itself; the latest numbers of a window count. Rows without a time are in no window.
    """
    spark = stream.sparkSession
    folder = folder or _run_folder(spark)
    counted = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("window"), *groups).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(passed.cast("int"), F.lit(0))).alias("n_passed"))
    changed = counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *groups, "n", "n_passed")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/windows/batch={number}")

    run = (
        changed.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    stored = spark.read.schema(T.StructType([*changed.schema, T.StructField("batch", T.LongType())])).parquet(f"{folder}/windows")
    latest = F.max_by(F.struct("n", "n_passed"), "batch").alias("__z")
    return stored.groupBy("window_start", "window_end", *groups).agg(latest).select(
        "window_start", "window_end", *groups, "__z.n", "__z.n_passed", (F.col("__z.n_passed") / F.col("__z.n")).alias("pass_fraction"))

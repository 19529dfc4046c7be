"""Streaming forms of the monitors: interval metrics, streak alarms, windowed counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def source(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A Parquet folder or file as a stream; as a pattern, since the reader takes a plain path for a folder."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path}*")


def arriving(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The Parquet files of the folders in a folder as a stream, in the order in which they came; like has their columns."""
    return spark.readStream.schema(like.schema).parquet(f"{folder}/*")


def interval_metrics(events: DataFrame, run: str, step: str, value: str, every: int) -> DataFrame:
    """Readings, mean, sum and last value of each run and interval of steps, as far as read."""
    interval = F.floor(F.col(step) / every).cast("long").alias("interval")
    return events.groupBy(run, interval).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.sum(value).alias("total"), F.max_by(value, step).alias("last"))


def streak_alarms(events: DataFrame, run: str, step: str, value: str, floor: float, streak: int) -> DataFrame:
    """run and first_alarm (a step), once for each run that has streak readings in a row below the floor; steps come in order from batch to batch."""

    def check(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        low, alarmed = state.get if state.exists else (0, False)
        rows = pd.concat(batches).sort_values(step)
        for at, v in zip(rows[step], rows[value], strict=True):
            low = low + 1 if v < floor else 0
            if low >= streak and not alarmed:
                alarmed = True
                yield pd.DataFrame({run: [key[0]], "first_alarm": [at]})
        state.update((low, alarmed))

    return events.select(run, step, value).groupBy(run).applyInPandasWithState(check, f"{run} long, first_alarm long", "low long, alarmed boolean", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, ts: str, by: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling time window; windows close when the watermark passes them."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.window(ts, width), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def run_to_end(stream: DataFrame, mode: str, folder: str, stop: Callable[[DataFrame], bool] | None = None) -> DataFrame:
    """Reads what there is and returns the sink's rows: all of them (append) or the last state (complete).

    Batches are written by number, so one that runs again after a failure replaces
    itself; progress is kept in the folder. stop: ends the query after a batch of which it is true.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        path = f"{folder}/rows/batch={number if mode == 'append' else 0}"
        batch.write.mode("overwrite").parquet(path)
        if stop and stop(spark.read.parquet(path)):
            raise StopIteration

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception as e:
        if "StopIteration" not in str(e):
            raise
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows").select(stream.columns)

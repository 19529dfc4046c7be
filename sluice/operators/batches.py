"""Batches within a padded budget, from windows of rows in reading order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.arrays import mask, padded
from sluice.operators.ordering import folded, placed, seeded


def buffered(rows: DataFrame, order: str, window: int = 256) -> DataFrame:
    """rows with buffer: window of them each in the order of a column, however its values lie."""
    out = placed(rows, [F.col(order)], "__rank")
    return out.withColumn("buffer", F.floor(F.col("__rank") / window).cast("long")).drop("__rank")


def packed(rows: DataFrame, length: str, order: str, budget: int, window: int = 256) -> DataFrame:
    """rows with buffer and batch: in each buffer by ascending length, a batch closes when one more would pad it beyond the budget.

    Every row is in one batch; one longer than the budget is alone in its.
    """

    def step(state: tuple[int, int], v: int) -> tuple[tuple[int, int], int]:
        n, batch = state
        if n and (n + 1) * v > budget:
            n, batch = 0, batch + 1
        return (n + 1, batch), batch

    return folded(buffered(rows, order, window), ["buffer"], [length, order], length, "batch", "long", lambda: (0, 0), step)


def padded_batches(rows: DataFrame, values: str, batch: str) -> DataFrame:
    """rows with input (values, padded to the longest of the batch) and mask."""
    longest = rows.groupBy(batch).agg(F.max(F.size(values)).alias("__longest"))
    out = rows.join(longest, batch)
    return out.withColumns({"input": padded(F.col(values), F.col("__longest")), "mask": mask(F.col(values), F.col("__longest"))}).drop("__longest")


def dealt(batched: DataFrame, seed: int) -> DataFrame:
    """batched with position: the place of a row's batch among those of its buffer, in a seeded order; the longest don't always come last."""
    order = seeded(F.concat_ws(":", "buffer", "batch"), seed)
    return batched.withColumn("position", (F.dense_rank().over(Window.partitionBy("buffer").orderBy(order)) - 1).cast("long"))

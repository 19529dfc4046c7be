"""Streak alarms of runs that were resumed: the streak that a trimmed curve ends in goes on, and a run that falls silent is told."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaks(low: np.ndarray, before: int) -> np.ndarray:
    """For each reading, how many in a row up to it are low; before: how many were before the first."""
    at = np.arange(1, len(low) + 1)
    broken = np.maximum.accumulate(np.where(low, 0, at))
    return np.where(broken > 0, at - broken, at + before)


class StreakProcessor(StatefulProcessor):
    """State of a run: its streak, its last step, and whether it has alarmed."""

    def __init__(self, run: str, step: str, value: str, floor: float, streak: int, silent_ms: int | None) -> None:
        self.run, self.step, self.value, self.floor, self.streak, self.silent_ms = run, step, value, floor, streak, silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("streak", "low long, last long, alarmed boolean")

    def grown(self, rows: pd.DataFrame, low: int, last: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Steps behind the last, ascending, and the streak at each."""
        rows = rows.sort_values(self.step, kind="stable")
        steps, values = rows[self.step].to_numpy(), rows[self.value].to_numpy(float)
        new = np.ones(len(steps), bool) if last is None else steps > last
        return steps[new], streaks(values[new] < self.floor, low)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: object) -> None:  # noqa: N802, N803
        steps, lengths = self.grown(initialState, 0, None)
        self.state.update((int(lengths[-1]), int(steps[-1]), False))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        low, last, alarmed = self.state.get() if self.state.exists() else (0, None, False)
        steps, lengths = self.grown(pd.concat(rows), low, last)
        if len(steps):
            hits = steps[lengths >= self.streak]
            if len(hits) and not alarmed:
                alarmed = True
                yield self.row(key[0], "alarm", hits[0])
            self.state.update((int(lengths[-1]), int(steps[-1]), bool(alarmed)))
        if self.silent_ms is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """The run is over: its last step is told, and its state is let go."""
        last = self.state.get()[1] if self.state.exists() else None
        self.state.clear()
        if last is not None:
            yield self.row(key[0], "silent", last)

    def row(self, run: object, kind: str, step: int) -> pd.DataFrame:
        return pd.DataFrame({self.run: [run], "kind": [kind], "step": [int(step)]})

    def close(self) -> None:
        """Nothing is held open."""


def use_rocksdb(spark: SparkSession) -> None:
    """State with variables and timers needs this store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def resumed_alarms(events: DataFrame, curve: DataFrame | None, run: str, step: str, value: str, floor: float, streak: int, silent_ms: int | None = None) -> DataFrame:
    """run, kind and step: ``alarm`` at the first step at which a run has streak readings in a row below the floor, once a run,
    and ``silent`` with the last step of a run from which nothing came for silent_ms.

    curve: the readings up to the step from which the runs resume (a batch table, as ``monitor.trimmed`` gives it); they count for streaks, raise no
    alarm of their own, and are taken in once, by the first batch of a new query. Readings of steps that a run has had are
    passed over, so that replayed ones don't count twice; of a batch, a run's readings are put in order. A null reading is not below the floor.
    """
    use_rocksdb(events.sparkSession)
    kind = events.schema[run].dataType.simpleString()
    before = None if curve is None else curve.select(run, step, value).groupBy(run)
    processor = StreakProcessor(run, step, value, floor, streak, silent_ms)
    mode = "none" if silent_ms is None else "processingTime"
    return events.select(run, step, value).where(F.col(run).isNotNull()).groupBy(run).transformWithStateInPandas(processor, f"`{run}` {kind}, kind string, step long", "append", mode, before)


def states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """run and its state (low, last, alarmed), read back from a query's checkpoint."""
    rows = spark.read.format("statestore").option("stateVarName", "streak").load(checkpoint)
    return rows.select(F.col("key").getField("key").alias("run") if "key" in rows.schema["key"].dataType.names else F.col("key.*"), "value.*")

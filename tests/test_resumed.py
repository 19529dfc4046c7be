import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.test_operators import values

from sluice.streaming import monitors, resumed

KINDS = "run long, step long, v double"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=30), st.integers(0, 5))
def test_streaks(low, before):
    want, n = [], before
    for x in low:
        n = n + 1 if x else 0
        want.append(n)
    assert resumed.streaks(np.array(low, bool), before).tolist() == want


def test_a_streak_from_before_the_resume_step(spark, tmp_path):
    curve = values(spark, [(1, s, 50.0 if s < 7 else 3.0) for s in range(1, 11)] + [(2, s, 3.0 if s < 9 else 50.0) for s in range(1, 11)] + [(3, 1, 3.0)], KINDS)
    lots = [[(1, 10, 3.0), (1, 9, 3.0), (2, 11, 3.0), (4, 1, 3.0)], [(2, 12, 3.0), (1, 11, 3.0), (4, 2, None), (4, 3, 3.0)], [(1, 12, 3.0), *((2, s, 3.0) for s in range(13, 16)), *((4, s, 3.0) for s in range(8, 3, -1))]]
    folder, got = str(tmp_path), []
    for i, rows in enumerate(lots):
        values(spark, rows, KINDS).write.parquet(f"{folder}/in/lot-{i}")
        stream = resumed.resumed_alarms(monitors.arriving(spark, f"{folder}/in", curve), curve, "run", "step", "v", 10.0, 5)
        got.append(sorted(tuple(r) for r in monitors.run_to_end(stream, "append", folder).collect()))
    assert got == [[], [(1, "alarm", 11)], [(1, "alarm", 11), (2, "alarm", 15), (4, "alarm", 7)]]
    state = {r.run: (r.low, r.last, r.alarmed) for r in resumed.states(spark, f"{folder}/progress").collect()}
    assert state == {1: (6, 12, True), 2: (5, 15, True), 3: (1, 1, False), 4: (6, 8, True)}


def test_a_silent_run_is_told_once(spark, tmp_path):
    folder = str(tmp_path)
    values(spark, [(1, s, 50.0) for s in range(1, 5)] + [(2, 9, 1.0)], KINDS).write.parquet(f"{folder}/in/lot-0")
    like = spark.read.parquet(f"{folder}/in/lot-0")
    stream = resumed.resumed_alarms(monitors.arriving(spark, f"{folder}/in", like), None, "run", "step", "v", 10.0, 5, silent_ms=1000)
    query = stream.writeStream.format("memory").queryName("silent").option("checkpointLocation", f"{folder}/progress").start()
    try:
        until = time.time() + 90
        while time.time() < until and spark.table("silent").count() < 2:
            time.sleep(1)
        time.sleep(3)
        assert sorted(tuple(r) for r in spark.table("silent").collect()) == [(1, "silent", 4), (2, "silent", 9)]
    finally:
        query.stop()


def test_runs_without_a_curve(spark, tmp_path):
    values(spark, [(1, s, 1.0) for s in range(1, 9)] + [(None, 1, 1.0)], KINDS).write.parquet(f"{tmp_path}/in/lot-0")
    like = spark.read.parquet(f"{tmp_path}/in/lot-0")
    stream = resumed.resumed_alarms(monitors.arriving(spark, f"{tmp_path}/in", like), None, "run", "step", "v", 10.0, 5)
    assert [tuple(r) for r in monitors.run_to_end(stream, "append", str(tmp_path)).collect()] == [(1, "alarm", 5)]

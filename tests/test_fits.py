import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import cuts, fits, split
from sluice.operators.ordering import seeded
from tests.test_operators import merged_by_loop, values


def by_loop(lengths, room):
    out = []
    for x in lengths:
        out.append(x <= room)
        room -= x if x <= room else 0
    return out, room


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(0, 120))
def test_taken(lengths, room):
    got, left = fits.taken(np.array(lengths, np.int64), room)
    assert (got.tolist(), left) == by_loop(lengths, room)


@pytest.mark.parametrize("kind", ["like", "falling", "pairs", "mixed"])
def test_taken_of_a_million(kind):
    rng = np.random.default_rng(1)
    lengths = {"like": rng.integers(3_000, 30_000, 10**6), "falling": np.arange(10**6, 0, -1), "pairs": np.ravel(np.column_stack([np.ones(500_000, int), np.arange(500_000, 0, -1)])), "mixed": rng.choice([0, 1, 7, 900, 10**6, 10**7], 10**6)}[kind]
    room = 500_000 if kind == "pairs" else 43_200_000
    began = time.time()
    got, left = fits.taken(lengths, room)
    assert time.time() - began < 20
    want, rest = by_loop(lengths.tolist(), room)
    assert got.tolist() == want and left == rest


@pytest.mark.parametrize("block", [5, 40, 1 << 16])
def test_skip_fit_of_hot_channels_in_rounds(spark, block):
    rng = random.Random(block)
    rows = [(i, rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([1, 2, 3, 500, 900, 2000])) for i in range(3000)]
    frame = values(spark, rows, "row_index long, channel_id string, duration_ms long").withColumn("o", seeded(F.col("row_index"), 7))
    got = {r.row_index for r in fits.skip_fit(frame, "channel_id", "row_index", "duration_ms", "o", 1500, block).collect()}
    want, by = set(), {}
    for i, c, d in sorted(rows, key=lambda r: hashlib.md5(f"7:{r[0]}".encode()).hexdigest()):
        if by.setdefault(c, 0) + d <= 1500:
            by[c] += d
            want.add(i)
    assert got == want


def test_skip_fit_of_nothing(spark):
    empty = values(spark, [], "row_index long, channel_id string, duration_ms long").withColumn("o", seeded(F.col("row_index"), 7))
    assert fits.skip_fit(empty, "channel_id", "row_index", "duration_ms", "o", 10).count() == 0


def lots_by_loop(rows, target):
    out, state = {}, {}
    for c, i, d in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        total, first = state.get(c, (0, None))
        first = i if first is None else first
        out[c, i] = first
        state[c] = (0, None) if total + d >= target else (total + d, first)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(1, 25), st.data())
def test_pieces_tell_how_a_channel_goes_on(lengths, target, data):
    """For every arriving sum just one piece holds, and it gives the sum and the lot with which a loop goes on."""
    orders = np.arange(100, 100 + len(lengths))
    told = fits.pieces(np.array(lengths, np.int64), orders, target)
    for carry in range(target):
        (low, high, total, start, begun, through), = [p for p in told if p[0] <= carry <= p[1]]
        want, lot = carry, "before"
        for i, d in zip(orders, lengths, strict=True):
            lot = int(i) if lot is None else lot
            want += d
            if want >= target:
                want, lot = 0, None
        assert (carry + total if through else total) == want
        assert through == (lot == "before") and (through or start == lot)


@pytest.mark.parametrize("block,n", [(7, 300), (50, 1000), (1 << 20, 1000)])
def test_lots_over_blocks(spark, monkeypatch, block, n):
    dealt, saved = [], fits.saved
    monkeypatch.setattr(fits, "saved", lambda df, name: dealt.append(saved(df, name)) or dealt[-1])
    rng = random.Random(n + block)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None, "z"]), i * 3, rng.choice([0, 0, 1, 4, 9, 30])) for i in range(n)]
    got = fits.lots(values(spark, rows, "c string, i long, d long").repartition(5), "c", "i", "d", 20, block=block)
    assert {(r.c, r.i): r.lot for r in got.collect()} == lots_by_loop(rows, 20)
    if block < n:
        assert dealt[0].where("c = 'hot'").select("__block").distinct().count() > 3


def test_lots_that_never_or_always_close(spark):
    rows = [("a", i, 1) for i in range(200)]
    frame = values(spark, rows, "c string, i long, d long")
    assert {r.lot for r in fits.lots(frame, "c", "i", "d", 10**6, block=9).collect()} == {0}
    assert {r.lot for r in fits.lots(frame, "c", "i", "d", 1, block=9).collect()} == set(range(200))
    assert {r.lot for r in fits.lots(frame, "c", "i", "d", 0).collect()} == set(range(200))
    assert fits.lots(frame.limit(0), "c", "i", "d", 5).count() == 0


def test_merge_short_of_one_hot_channel(spark, monkeypatch):
    monkeypatch.setattr(cuts, "lots", lambda *a, **k: fits.lots(*a, **k, block=40))
    rng = random.Random(9)
    rows = [(f"i{n}", "hot" if n % 5 else "b", rng.randint(1, 12), n) for n in range(600)]
    out = cuts.merge_short(values(spark, rows, "id string, channel_id string, duration_ms long, row_index long"), 9, 25)
    assert sorted((r.cut_id, r.n, r.total_ms) for r in out.collect()) == merged_by_loop(rows, 9, 25)


def test_channel_cap_plan_is_small(spark):
    from sluice.plans.queries import channel_cap

    plan = channel_cap(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 10 and "MapInArrow" not in plan
    assert sum("n_chars" in line for line in plan.splitlines() if "Relation" in line) <= 3


def test_totals_may_be_given(spark):
    rows = values(spark, [(i, f"c{i % 3}", "en", 10 * (i + 1)) for i in range(30)], "row_index long, channel_id string, language string, duration_ms long")
    limits = split.Limits(channel=1500)
    ids = lambda df: sorted(r.row_index for r in df.collect())
    assert ids(split.capped(rows, limits)) == ids(split.capped(rows, limits, split.channel_totals(rows).select("channel_id", "total_ms")))

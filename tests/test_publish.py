import os
import random

import pytest
from pyspark.sql import functions as F
from tests.test_operators import values

from sluice import checks
from sluice.operators import batches, files, ordering
from sluice.sources import readers, writers


def write(rows, at):
    rows.write.json(at)


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before


def test_rules_are_counted_while_rows_are_written(spark, tmp_path):
    rows = values(spark, [(i, f"p{i}") for i in range(100)], "id long, path string")
    path = str(tmp_path / "out")
    rules = {"no path": F.col("path").isNull(), "late": F.col("id") > 200}
    assert jobs_of(spark, lambda: checks.published(rows, path, write, rules)) == 1
    assert spark.read.json(path).count() == 100
    bad = rows.withColumn("path", F.when(F.col("id") % 50 != 0, F.col("path")))
    with pytest.raises(checks.CheckError, match="no path: 2 rows"):
        checks.published(bad, path, write, rules)
    assert spark.read.json(path).count() == 100 and os.listdir(tmp_path) == ["out"]  # what was there stays
    with pytest.raises(checks.CheckError, match="repeated id: 4 rows"):
        checks.published(rows.union(rows.where("id < 2")), path, write, unique="id")
    assert checks.published(rows.where("id < 3"), path, write, unique="id") == 3
    assert "__same" not in spark.read.json(path).columns and spark.read.json(path).count() == 3
    checks.published(rows.limit(0), path, write, rules, "id")
    with pytest.raises(Exception):
        checks.published(rows.select(F.raise_error(F.lit("x")).cast("long").alias("id")), path, write)
    assert os.listdir(tmp_path) == ["out"]


def test_shards_with_a_long_cut_are_refused(spark, tmp_path):
    rows = values(spark, [(i, i // 5, i, 100 * i) for i in range(20)], "id long, shard_id long, position long, cut_ms long")
    writers.shards(rows, str(tmp_path / "s"), most=1900)
    with pytest.raises(checks.CheckError, match="longer"):
        writers.shards(rows, str(tmp_path / "s"), most=1800)
    assert readers.shards(spark, str(tmp_path / "s")).count() == 20


def test_curve_that_is_replayed_and_trimmed(spark, tmp_path):
    path = str(tmp_path / "curve")
    part = lambda low, high, v: values(spark, [(r, s, (s - 1) // 10, v) for r in (1, 2) for s in range(low, high)], "run long, step long, interval long, v double")
    writers.curve(part(1, 21, 1.0), path)
    writers.curve(part(11, 31, 2.0), path)  # the second interval again
    writers.curve(part(11, 31, 2.0), path)
    got = sorted((r.run, r.step, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(r, s, 1.0 if s < 11 else 2.0) for r in (1, 2) for s in range(1, 31)]
    writers.trim_curve(spark, path, 14)
    assert sorted(r.step for r in spark.read.parquet(path).where("run = 2").collect()) == list(range(1, 15))
    assert not (tmp_path / "curve" / "run=1" / "interval=2").exists()
    writers.trim_curve(spark, path, 0)
    assert not [p for p in (tmp_path / "curve").rglob("*.parquet")]
    writers.trim_curve(spark, str(tmp_path / "absent"), 5)


def test_curves_of_many_runs_have_few_folders(spark, tmp_path):
    path = str(tmp_path / "curve")
    part = lambda runs, low, high, v: values(spark, [(r, s, (s - 1) // 10, v) for r in runs for s in range(low, high)], "run long, step long, interval long, v double")
    everyone = [None, *range(300)]
    writers.curve(part(everyone, 1, 21, 1.0), path, buckets=4)
    writers.curve(part([None, 7, 8], 11, 31, 2.0), path, buckets=4)  # others of their buckets stay
    assert len({p.parent for p in (tmp_path / "curve").rglob("*.parquet")}) <= 3 * 4
    found = lambda: sorted((-1 if r.run is None else r.run, r.step, r.v) for r in spark.read.parquet(path).collect())
    again = {-1, 7, 8}
    want = sorted([(r, s, 2.0 if r in again and s > 10 else 1.0) for r in range(-1, 300) for s in range(1, 21)] + [(r, s, 2.0) for r in again for s in range(21, 31)])
    assert found() == want
    writers.trim_curve(spark, path, 14)
    assert found() == [x for x in want if x[1] <= 14]
    assert not list((tmp_path / "curve" / "interval=2").rglob("*.parquet"))


def test_index_in_parts(spark, tmp_path):
    rows = values(spark, [(f"a/{i:04d}.wav", i) for i in range(500, 0, -1)], "relpath string, size long")
    writers.index(rows, str(tmp_path / "i"))
    assert readers.index(spark, str(tmp_path / "i")).count() == 500
    lines = [line for p in sorted((tmp_path / "i").glob("part*")) for line in p.read_text().splitlines()[1:]]
    assert lines == sorted(lines) and len(lines) == 500


def test_places_of_sparse_keys(spark):
    rng = random.Random(2)
    keys = sorted({rng.choice([rng.randrange(10), rng.randrange(10**6), rng.randrange(10**15)]) for _ in range(700)})
    rows = values(spark, [(k,) for k in keys], "k long").repartition(7, F.hash("k"))
    assert [r["rank"] for r in ordering.placed(rows, [F.col("k")]).orderBy("k").collect()] == list(range(len(keys)))
    down = ordering.placed(rows, [F.col("k").desc()], parts=9)
    assert [r["rank"] for r in down.orderBy(F.desc("k")).collect()] == list(range(len(keys)))
    assert ordering.placed(rows.limit(0), [F.col("k")]).count() == 0
    sizes = {r.buffer: r["count"] for r in batches.buffered(rows, "k", 64).groupBy("buffer").count().collect()}
    assert all(n == 64 for b, n in sizes.items() if b < len(sizes) - 1)


def test_bins_have_like_bytes(spark):
    rng = random.Random(3)
    for sizes in ([rng.randrange(1, 10_000) for _ in range(800)], [1000] * 800, [int(1.01**i) for i in range(800)]):
        rows = values(spark, [(f"f{i}", s) for i, s in enumerate(sizes)], "filename string, size long")
        per = {r.bin: r.total for r in files.binned(rows, "size", "filename", 8).groupBy("bin").agg(F.sum("size").alias("total")).collect()}
        assert len(per) == 8 and max(per.values()) <= 1.1 * sum(sizes) / 8


def test_copy_by_uri_in_bins(spark, tmp_path):
    source, target = tmp_path / "source", tmp_path / "target"
    for i in range(40):
        (source / f"d{i % 3}").mkdir(parents=True, exist_ok=True)
        (source / f"d{i % 3}" / f"{i}.wav").write_bytes(bytes([i]) * i * 100)
    rows = values(spark, [(f"d{i % 3}/{i}.wav", i * 100) for i in range(41)], "filename string, size long")
    done = files.copy(rows, f"file://{source}", f"file://{target}", size="size", bins=4)
    assert sorted(r.status for r in done.collect()) == ["copied"] * 40 + ["missing"]
    assert all((target / f"d{i % 3}" / f"{i}.wav").read_bytes() == bytes([i]) * i * 100 for i in range(40))
    assert not list(target.rglob("*.part"))
    (target / "d1" / "7.wav").unlink()
    (target / "d1" / "7.wav").mkdir()  # can't be replaced by a file
    again = files.copy_until_done(rows, str(source), str(target), size="size", tries=2)
    status = {r.filename: (r.status, r.error) for r in again.collect()}
    assert len(status) == 41 and status["d1/7.wav"][0] == "failed" and status["d1/7.wav"][1]
    assert sum(s == "skipped" for s, _ in status.values()) == 39

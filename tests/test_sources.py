import json
import os
import random
import tarfile

import pytest
from pyspark.sql import functions as F
from tests.test_operators import values

from sluice import checks
from sluice.operators import cuts
from sluice.sources import archives, paged, tree, writers
from sluice.streaming import epochs


def plain_walk(root, folders, suffix):
    out = []
    for folder in folders:
        for at, dirs, names in os.walk(root / folder):
            dirs[:] = [d for d in dirs if not os.path.islink(os.path.join(at, d))]
            out += [(os.path.relpath(p, root), os.path.getsize(p)) for n in names if n.lower().endswith(f".{suffix}") and not os.path.islink(p := os.path.join(at, n))]
    return sorted(out, key=lambda x: x[0].encode())


@pytest.mark.parametrize("entries", [50, 20_000])
def test_walk_of_ten_thousand_files(spark, tmp_path, entries):
    rng, root = random.Random(4), tmp_path / "root é"
    folders = ["Si", "Ta/in"]
    paths = [root / f for f in folders]
    for i in range(300):
        paths.append(paths[-1 if i % 3 == 0 else rng.randrange(len(paths))] / rng.choice([f"g{i}", f"_g{i}", f".g{i}", f"g {i}é"]))
    for p in paths:
        p.mkdir(parents=True, exist_ok=True)
    hot = paths[7]
    for i in range(10_000):
        at = hot if i % 3 == 0 else paths[rng.randrange(len(paths))]
        (at / (rng.choice(["", "_", "."]) + f"f{i}" + rng.choice([".wav", ".WAV", ".wAv", ".txt", ""]))).write_bytes(b"x" * (i % 7))
    (root / "Si" / "link.wav").symlink_to(hot / "nothing")
    (root / "Si" / "around").symlink_to(root)
    want = plain_walk(root, folders, "wav")
    got = tree.walk(spark, str(root), folders, "wav", entries)
    assert [tuple(r) for r in got.collect()] == want and len(want) > 5000


def test_walk_of_nothing_and_of_errors(spark, tmp_path):
    (tmp_path / "Si" / "empty").mkdir(parents=True)
    assert tree.walk(spark, f"file://{tmp_path}", ["Si"]).count() == 0
    assert tree.walk(spark, str(tmp_path), []).count() == 0
    with pytest.raises(checks.CheckError, match="Ta"):
        tree.walk(spark, str(tmp_path), ["Si", "Ta"])
    (tmp_path / "Si" / "a\tb.wav").write_bytes(b"")
    with pytest.raises(checks.CheckError):
        tree.walk(spark, str(tmp_path), ["Si"])


def items(spark, n, size):
    rows = values(spark, [(f"c{i}é", bytes([i % 256]) * (i % 50), "ta" if i % 2 else None, i) for i in range(n)], "id string, payload binary, language string, row_index long")
    return cuts.sharded(rows, 7, size)


def test_archives_round_trip(spark, tmp_path):
    rows = items(spark, 237, 20)
    archives.write_archives(rows, str(tmp_path / "out"), extension="flac")
    names = sorted(os.listdir(tmp_path / "out"))
    assert names == [f"shard-{i:06d}.tar" for i in range(12)]
    with tarfile.open(tmp_path / "out" / names[0]) as t:
        members = t.getnames()
    assert len(members) == 40 and members[0].endswith(".flac") and members[1].endswith(".json")
    back = archives.read_archives(spark, str(tmp_path / "out"))
    got = {(r.shard_id, r.shard_id * 20 + r.position, r.id, bytes(r.payload), json.loads(r.meta)["language"], json.loads(r.meta)["row_index"]) for r in back.collect()}
    assert got == {(r.shard_id, r.position, r.id, bytes(r.payload), r.language, r.row_index) for r in rows.collect()}


def test_archives_of_some_shards(spark, tmp_path):
    archives.write_archives(items(spark, 100, 10), str(tmp_path))
    some = archives.read_archives(spark, str(tmp_path)).where(F.col("shard_id").isin(3, 5))
    assert {r.shard_id for r in some.collect()} == {3, 5} and some.count() == 20
    assert some.rdd.getNumPartitions() == 2
    assert archives.read_archives(spark, str(tmp_path)).where("shard_id = 77").count() == 0


def test_compressed_archives(spark, tmp_path):
    rows = items(spark, 50, 20)
    archives.write_archives(rows, str(tmp_path / "out"), compression="gzip")
    assert sorted(os.listdir(tmp_path / "out")) == [f"shard-{i:06d}.tar.gz" for i in range(3)]
    with tarfile.open(tmp_path / "out" / "shard-000002.tar.gz", "r:gz") as t:
        assert len(t.getnames()) == 20
    back = archives.read_archives(spark, str(tmp_path / "out"))
    assert {(r.id, bytes(r.payload)) for r in back.collect()} == {(r.id, bytes(r.payload)) for r in rows.collect()}
    with pytest.raises(Exception, match="there already"):
        archives.write_archives(rows, str(tmp_path / "out"))
    archives.write_archives(rows, str(tmp_path / "out"), overwrite=True)
    assert sorted(os.listdir(tmp_path / "out")) == [f"shard-{i:06d}.tar" for i in range(3)]


def test_archives_written_again(spark, tmp_path):
    rows = items(spark, 60, 20)
    archives.write_archives(rows, str(tmp_path))
    with pytest.raises(Exception, match="there already"):
        archives.write_archives(rows, str(tmp_path))
    archives.write_archives(rows.where("shard_id < 2"), str(tmp_path), overwrite=True)
    assert sorted(os.listdir(tmp_path)) == ["shard-000000.tar", "shard-000001.tar"]
    archives.write_archives(rows.where("shard_id = 2"), str(tmp_path))
    assert archives.read_archives(spark, str(tmp_path)).count() == 60


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    rows = items(spark, 100, 10)
    bad = rows.withColumn("payload", F.when(F.col("row_index") == 55, F.raise_error(F.lit("no such file")).cast("binary")).otherwise(F.col("payload")))
    for wrong in (bad, rows.withColumn("shard_id", F.when(F.col("row_index") != 5, F.col("shard_id")))):
        with pytest.raises(Exception):
            archives.write_archives(wrong, str(tmp_path / "out"))
        assert not (tmp_path / "out").exists() or os.listdir(tmp_path / "out") == []


class Flaky:
    """Pages of ten numbers; every page fails once in each process."""

    filters = ("n",)

    def __init__(self):
        self.failed = set()

    def page(self, tab, token, where):
        low = int(token or 0)
        if low not in self.failed:
            self.failed.add(low)
            raise OSError("busy")
        rows = [{"n": i, "kind": f"{tab}{i % 3}"} for i in range(low, min(low + 10, 45))]
        return [r for r in rows if all(paged.MEETS[how](r[c], v) for c, how, v in where)], str(low + 10) if low < 40 else None


class Circle(Flaky):
    def page(self, tab, token, where):
        return [], "1"


def test_paged_tabs(spark):
    rows = paged.paged(spark, Flaky(), ["a", "b"], "n long, kind string, absent string", wait=0.01)
    assert sorted(map(tuple, rows.collect())) == sorted((t, i, f"{t}{i % 3}", None) for t in "ab" for i in range(45))
    some = rows.where("tab = 'b' and n >= 38 and kind <> 'b1'")
    assert sorted(r.n for r in some.collect()) == [38, 39, 41, 42, 44] and some.rdd.getNumPartitions() == 1
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and ">= 38" in line and "PushedFilters" not in line]
    assert not filters, plan
    with pytest.raises(Exception, match="came twice"):
        paged.paged(spark, Circle(), ["a"], "n long", name="circle").collect()


def test_exported_pages(spark, tmp_path):
    rows = values(spark, [(i, f"t{i % 2}", f"é{i}") for i in range(95)], "n long, tab string, name string")
    paged.export(rows.withColumn("page", F.floor(F.col("n") / 10)), str(tmp_path), "tab", "page")
    client = paged.FolderClient(str(tmp_path), ("n",))
    got = paged.paged(spark, client, ["t0", "t1"], "n long, name string", name="folder")
    assert sorted(map(tuple, got.collect())) == sorted((f"t{i % 2}", i, f"é{i}") for i in range(95))
    assert sorted(r.n for r in got.where("n < 7").collect()) == list(range(7))


def test_epochs_come_whole_and_go_on(spark, tmp_path):
    rows = items(spark, 130, 10).drop("payload")
    writers.shards(rows, str(tmp_path / "shards"))
    stream = lambda: epochs.epochs(spark, str(tmp_path / "shards"), str(tmp_path / "progress"), 5, 3, shards_per_batch=4, world=2, workers=2)
    first = epochs.run_epochs(stream(), str(tmp_path / "run"), stop_after=6)
    assert 0 < first.count() < 390
    got = epochs.run_epochs(stream(), str(tmp_path / "run"))
    found = got.collect()
    for epoch in range(3):
        own = [r for r in found if r.epoch == epoch]
        assert sorted(r.row_index for r in own) == list(range(130))  # each once, over all workers
        workers = {w: {r.shard_id for r in own if r.worker == w} for w in range(4)}
        assert sum(map(len, workers.values())) == 13 and max(map(len, workers.values())) <= 4
        want = {r.shard_id: r.worker for r in cuts.dealt(rows.select("shard_id").distinct(), 5, epoch, 2, 2).collect()}
        assert {s: w for w, ss in workers.items() for s in ss} == want
    assert len({tuple(sorted({(r.shard_id, r.worker) for r in found if r.epoch == e})) for e in range(3)}) == 3


def test_epochs_of_many_shards_take_few_batches_and_tasks(spark, tmp_path):
    for i in range(1000):
        (tmp_path / f"shard_id={i}").mkdir()
    options = {"path": str(tmp_path), "progress": str(tmp_path / "progress"), "epochs": "2", "shards_per_batch": "4", "batches_per_epoch": "5", "world": "2", "workers": "2"}
    reader, tasks, batches = epochs.EpochReader(options, spark.range(1).schema), [], 0
    at = reader.initialOffset()
    while (end := reader.latestOffset()) != at:
        tasks, batches, at = tasks + reader.partitions(at, end), batches + 1, end
    assert batches == 10 and len(tasks) <= 10 * 4 * 2
    for epoch in range(2):
        order = epochs.dealt_order(range(1000), 0, epoch)
        assert sorted((s, t.worker) for t in tasks if t.epoch == epoch for s in t.shards) == sorted((s, k % 4) for k, s in enumerate(order))


def test_worker_shards_prunes_folders_while_it_runs(spark):
    from sluice.plans.queries import worker_shards

    plan = worker_shards(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()

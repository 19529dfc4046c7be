import csv
import json
import random

import pytest
from tests.test_operators import sequential_split

from sluice import checks, params
from sluice.plans import selection
from sluice.sources import readers, writers

COLUMNS = ["source_id", "title", "genre", "duration_minutes", "name_in_drive", "size", "to_train", "language", "stored_date"]


def catalog_of(seed):
    """Rows of a catalog, and paths and sizes of an index: some rows repeat, some have no file, some several, some share one."""
    rng, rows, index = random.Random(seed), [], {}
    for i in range(300):
        lang, genre, source = rng.choice(["Ta", "Si"]), rng.choice(["news", "talk"]), f"ch{rng.randrange(15)}"
        row = {"source_id": f" {source} ", "title": f"t|{i}", "genre": genre, "duration_minutes": rng.randrange(1, 4000) / 2000, "name_in_drive": f"{i}é.wav", "size": i * 10, "to_train": rng.choice([" Yes", "yes", "no"]), "language": lang, "stored_date": str(i)}
        rows.append(row)
        kind = i % 10
        if kind == 0:
            continue
        index[f"{lang.upper()}/{genre}/{source}/{i}é.wav"] = i * 10
        if kind == 1:
            index[f"{lang.upper()}/{genre}/other/{i}é.wav"] = i * 10
        if kind == 2:
            rows.append(row | {"stored_date": "later"})
        if kind == 3:
            rows.append(row | {"source_id": "ch0x"})
    return rows, index


def written(tmp_path, rows, index):
    with open(tmp_path / "catalog.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, COLUMNS)
        out.writeheader()
        out.writerows(rows)
    (tmp_path / "index.tsv").write_text("relpath\tsize\n" + "".join(f"{p}\t{s}\n" for p, s in sorted(index.items())))
    (tmp_path / "block.txt").write_text("ch3\n\n")
    return params.SelectParams(seed=5, target_hours=1.2, language_mix={"Ta": 0.5, "Si": 0.5}, min_segment_seconds=3, max_segment_seconds=110, max_hours_per_channel=0.15, holdout_hours=0.3, catalog_path=str(tmp_path / "catalog.csv"), exclude_channels_file=str(tmp_path / "block.txt"), drive_root="", drive_index_path=str(tmp_path / "index.tsv"))


def by_hand(rows, index, settings):
    """status of each kept row, and the ids of both sides, by loops over the rows."""
    paths, seen, used, status = {}, set(), set(), {}
    for path, size in sorted(index.items()):
        a = path.split("/")
        paths.setdefault((a[0].lower(), a[1], a[-1], size), []).append(path)
    marked = 0
    for i, r in enumerate(rows):
        if r["to_train"].strip().lower() != "yes":
            continue
        marked += 1
        key = (r["language"].lower(), r["source_id"].strip(), r["name_in_drive"], r["size"])
        if key in seen:
            continue
        seen.add(key)
        got = paths.get((r["language"].lower(), r["genre"], r["name_in_drive"], r["size"]), [])
        status[i] = "no_match" if not got else "ambiguous" if len(got) > 1 else "duplicate_path" if got[0] in used else got[0]
        used |= set(got[:1]) if len(got) == 1 else set()
    good = [(i, rows[i]["source_id"].strip(), rows[i]["language"], round(rows[i]["duration_minutes"] * 60_000)) for i, s in status.items() if "/" in s]
    return marked, status, sequential_split(good, {"ch3"}, selection.limits_of(settings))


def test_one_call_from_catalog_to_reports(spark, tmp_path):
    rows, index = catalog_of(1)
    settings = written(tmp_path, rows, index)
    done = selection.run(spark, settings, str(tmp_path / "out"))
    marked, status, (train, held) = by_hand(rows, index, settings)
    names = lambda ids: sorted(status[i] for i in ids)
    assert train and held
    for path, ids in ((done.train, train), (done.holdout, held)):
        got = readers.manifest(spark, [path]).collect()
        assert sorted(r.filename for r in got) == names(ids) and len({r.id for r in got}) == len(ids)
        assert all(r.name_in_drive == r.filename.split("/")[-1] for r in got)
    lost = readers.csv(spark, done.unresolved).collect()
    assert sorted(r.reason for r in lost) == sorted(s for s in status.values() if "/" not in s) and {"ambiguous", "no_match", "duplicate_path"} == {r.reason for r in lost}
    stats = json.loads((tmp_path / "out" / "reports" / "selection_stats.json").read_text())
    assert stats["train_segments"] == len(train) and stats["holdout_segments"] == len(held)
    assert stats["cleaning"]["marked for training"] == marked and stats["cleaning"]["candidates"] == sum("/" in s for s in status.values())
    assert stats["cleaning"]["repeats left out"] == marked - len(status) > 0
    text = (tmp_path / "out" / "reports" / "selection_report.md").read_text()
    assert f"| candidates | {stats['cleaning']['candidates']} |" in text and "t\\|" in text


def test_catalogs_that_are_refused(spark, tmp_path):
    rows, index = catalog_of(2)
    for bad, message in (([r | {"to_train": "no"} for r in rows], "trained on"), ([r | {"size": 1} for r in rows], "file of its own"), ([*rows, rows[0] | {"source_id": " ", "to_train": "yes"}], "blank")):
        settings = written(tmp_path, bad, index)
        with pytest.raises(checks.CheckError, match=message):
            selection.run(spark, settings, str(tmp_path / "out"))
    assert not (tmp_path / "out" / "manifests").exists()


def test_newest_checkpoint_that_can_be_read(spark, tmp_path):
    root, needed = str(tmp_path / "run"), ["state.json", "model.json"]
    read = lambda path: json.loads(spark.read.text(f"{path}/state.json", wholetext=True).first()[0])
    assert readers.newest_state(spark, root, needed, read) is None
    for step in (3, 6, 12):
        writers.checkpoint(spark, root, step, {"state.json": json.dumps({"step": step}), "model.json": "{}"})
    (tmp_path / "run" / "checkpoint-20").mkdir()
    (tmp_path / "run" / "checkpoint-20" / "state.json").write_text("{}")
    stale = tmp_path / "run" / ".checkpoint-30-abc"
    stale.mkdir()
    (stale / "half").write_bytes(b"x")
    assert readers.newest_state(spark, root, needed, read) == (12, {"step": 12}) and not stale.exists()
    (tmp_path / "run" / "checkpoint-12" / "state.json").write_text("cut off")
    (tmp_path / "run" / "checkpoint-12" / ".state.json.crc").unlink(missing_ok=True)
    with pytest.warns(UserWarning, match="checkpoint 12"):
        assert readers.newest_state(spark, root, needed, read) == (6, {"step": 6})
    assert readers.newest_state(spark, root, needed, read, explicit=3) == (3, {"step": 3})
    with pytest.raises(Exception):
        readers.newest_state(spark, root, needed, read, explicit=12)
    with pytest.raises(checks.CheckError):
        readers.newest_state(spark, root, needed, read, explicit=20)


def test_white_space_in_cells_is_kept(spark, tmp_path):
    rows = spark.createDataFrame([(" a", "x\n y ", "yes "), ("b", "", " no")], "source_id string, title string, to_train string")
    path = writers.catalog(rows, str(tmp_path), ["source_id"])
    for at in (path, f"{tmp_path}/catalog_latest"):
        assert sorted(map(tuple, readers.csv(spark, at).collect())) == sorted(map(tuple, rows.collect()))
    files = spark.createDataFrame([(" a/b .wav ", 3)], "relpath string, size long")
    writers.index(files, f"{tmp_path}/index")
    assert [tuple(r) for r in readers.index(spark, f"{tmp_path}/index").collect()] == [(" a/b .wav ", 3)]

"""Operators on small inputs, with the outcomes that their rules call for."""

import json
import math
import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice import checks, params
from sluice.functions import arrays, schedules, text
from sluice.operators import batches, bench, catalog, cuts, files, labels, monitor, ordering, report, resolve, split
from sluice.sources import readers, writers
from sluice.streaming import monitors


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def values(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# parameters and barriers


def test_params_rules():
    good = dict(seed=1, target_hours=1.0, language_mix={"a": 0.5, "b": 0.5}, min_segment_seconds=1, max_segment_seconds=9, max_hours_per_channel=1, holdout_hours=1)
    assert params.SelectParams(**good).seed == 1
    for bad in ({"language_mix": {"a": 0.4}}, {"target_hours": 0}):
        with pytest.raises(ValueError):
            params.SelectParams(**good | bad)
    params.ShardParams(1000, 5, 15, 30)
    for bad in ((20, 25, 30), (5, 15, 18)):
        with pytest.raises(ValueError):
            params.ShardParams(1000, *bad)
    assert params.Params.of({"select": good | {"new": 1}, "more": 2}, strict=False).other == {"select": {"new": 1}, "more": 2}
    assert params.Params.of({"select": good, "more": 2}).other == {"more": 2}
    with pytest.raises(ValueError, match="new"):
        params.Params.of({"select": good | {"new": 1}})


def test_barriers(spark):
    df = values(spark, [(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(checks.CheckError):
        checks.require_columns(df, ["id", "w"])
    with pytest.raises(checks.CheckError):
        checks.require_unique(df, "id")
    with pytest.raises(checks.CheckError):
        checks.require_rows(df.where("id = 2"), "x")
    with pytest.raises(checks.CheckError):
        checks.require_disjoint(df, df, "v")
    with pytest.raises(checks.CheckError):
        checks.require_enough_shards(3, 2, 2)
    checks.require_none(df, F.col("v") == "c", "c")
    checks.require_enough_shards(4, 2, 2)


# catalog


def test_catalog_from_csv(spark, tmp_path):
    head = "source_id,language,title,duration_minutes,size,to_train,\n"
    (tmp_path / "X Tamil - Sinhala.csv").write_text(head + 's1,,"two\nlines ""quoted""",1.5,10, Yes,\ns2,sinhala,t,2,20,no,\n')
    (tmp_path / "X Sinhala - Tamil.csv").write_text(head + "s3,Tamil ,t,3,30,YES,\n")
    paths = [str(tmp_path / n) for n in ("X Tamil - Sinhala.csv", "X Sinhala - Tamil.csv")]
    both = readers.catalog(spark, paths, ["sinhala", "tamil"])
    assert both.columns == ["source_id", "language", "title", "duration_minutes", "size", "to_train", "source_tab"]
    assert {(r.source_id, r.language) for r in both.collect()} == {("s1", "sinhala"), ("s2", "sinhala"), ("s3", "tamil")}
    assert both.where("source_id = 's1'").first().title == 'two\nlines "quoted"'
    loaded = catalog.load(both, F.substring("source_id", 2, 9).cast("int"), defaults={"genre": "unknown"})
    assert {(r.row_index, r.duration_seconds, r.size_bytes, r.genre) for r in loaded.collect()} == {(1, 90.0, 10, "unknown"), (3, 180.0, 30, "unknown")}
    meta = {r.language: (r.total, r.to_train) for r in catalog.metadata(both, "language", "to_train").collect()}
    assert meta == {"sinhala": (2, 0), "tamil": (1, 1), None: (3, 1)}  # " Yes" isn't trimmed here
    path = writers.catalog(both, str(tmp_path / "out"), ["source_id", "language"], datetime(2025, 1, 2))
    assert path.endswith("catalog_20250102T000000Z") and readers.csv(spark, str(tmp_path / "out/catalog_latest")).count() == 3
    (tmp_path / "bad tamil.csv").write_text(head + "s4,sinhala,t,3,30,yes,\n")
    with pytest.raises(checks.CheckError, match="sinhala"):
        readers.catalog(spark, [str(tmp_path / "bad tamil.csv")], ["sinhala", "tamil"])
    with pytest.raises(checks.CheckError):
        catalog.load(values(spark, [("", "1", "1", "yes")], "source_id string, duration_minutes string, size string, to_train string"), F.lit(0))


def test_union_refuses_new_columns(spark):
    a, b = values(spark, [("1", "2")], "a string, b string"), values(spark, [("3",)], "a string")
    assert [tuple(r) for r in catalog.union_tabs([a, b]).orderBy("a").collect()] == [("1", "2"), ("3", "")]
    with pytest.raises(checks.CheckError):
        catalog.union_tabs([b, a])


# text


def test_text_functions(spark):
    assert one(spark, text.last_language(F.lit("Sinhala X Tamil - Pre-Tamil"), ["sinhala", "tamil"])) == "tamil"
    assert one(spark, text.last_language(F.lit("none"), ["sinhala", "tamil"])) is None
    assert one(spark, text.md_cell(F.lit("  a |\n b\t"))) == "a \\| b"
    ids = [one(spark, text.clip_id(F.lit(p))) for p in ("a/x.wav", "b/x.wav", "a/.x")]
    assert ids[0].startswith("x-") and ids[0] != ids[1] and len(ids[0]) == 12 and ids[2].startswith(".x-")
    assert [one(spark, text.family_of(F.lit(n))) for n in ("asr_omni_x", "er_a", "error", "asv1")] == ["asr", "er", None, "asv"]
    assert one(spark, text.parse_tags(F.lit(" a=1,, b = x=y ,a=2"))) == {"a": "2", "b": "x=y"}
    assert [one(spark, text.step_of(F.lit(n))) for n in ("checkpoint-12", "checkpoint-12-final", "x-checkpoint-1")] == [12, None, None]
    bad = values(spark, [("a",), ("=b",)], "t string")
    with pytest.raises(checks.CheckError):
        labels.refuse_bad_tags(bad, "t")


# resolve


def test_resolve_outcomes(spark):
    index = values(spark, [("Ta/news/c1/a.wav", 1), ("Ta/news/c2/a.wav", 2), ("Ta/news/c1/b.wav", 5), ("Ta/news/c2/b.wav", 5), ("Si/news/c1/a.wav", 1), ("Ta/x.wav", 9)], "relpath string, size long")
    rows = values(spark, [(0, "ta", "news", "a.wav", 1), (1, "Ta", "news", "a.wav", 1), (2, "ta", "news", "b.wav", 5), (3, "ta", "News", "a.wav", 1), (4, "ta", "news", "a.wav", 2), (5, None, "news", "a.wav", 1)], "row_index int, language string, genre string, filename string, size_bytes long")
    on = (F.lower("language") == F.col("k_language")) & (F.col("genre") == F.col("k_genre")) & (F.col("filename") == F.col("k_filename")) & (F.col("size_bytes") == F.col("k_size"))
    out = resolve.resolve(rows, resolve.path_lookup(index), on, "row_index")
    assert {r.row_index: (r.status, r.path) for r in out.collect()} == {0: ("resolved", "Ta/news/c1/a.wav"), 1: ("duplicate_path", None), 2: ("ambiguous", None), 3: ("no_match", None), 4: ("resolved", "Ta/news/c2/a.wav"), 5: ("no_match", None)}
    assert resolve.summary(out).first().asDict() == {"no_match": 2, "ambiguous": 1, "duplicate_path": 1, "resolved": 2}


def test_first_of_each(spark):
    rows = values(spark, [(2, "A"), (0, "b"), (1, "a"), (3, "B")], "i int, k string")
    assert {r.i for r in resolve.first_of_each(rows, [F.lower("k")], "i").collect()} == {0, 1}


# split


def sequential_split(rows, blocked, limits):
    import hashlib

    order = lambda k: hashlib.md5(f"{limits.seed}:{k}".encode()).hexdigest()
    good = [r for r in rows if limits.shortest <= r[3] <= limits.longest and r[1] not in blocked]
    by = {}
    for r in sorted(good):
        by.setdefault(r[1], []).append(r)
    names, held, total = sorted(by, key=order), set(), 0
    for c in names:
        if total >= limits.holdout:
            break
        held.add(c)
        total += sum(r[3] for r in by[c])
    train = set()
    for lang, share in limits.mix.items():
        took = 0
        for c in names:
            if c in held or by[c][0][2] != lang:
                continue
            if took >= int(limits.target * share):
                break
            items = by[c]
            if sum(r[3] for r in items) > limits.channel:
                used, fit = 0, []
                for r in sorted(items, key=lambda r: order(r[0])):
                    if used + r[3] <= limits.channel:
                        used += r[3]
                        fit.append(r)
                items = fit
            train |= {r[0] for r in items}
            took += sum(r[3] for r in items)
    return train, {r[0] for c in held for r in by[c]}


@pytest.mark.parametrize("seed", range(3))
def test_split_matches_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"c{rng.randrange(12)}", rng.choice(["en", "fr"]), rng.randrange(1000, 90_000)) for i in range(400)]
    limits = split.Limits(seed=seed, shortest=3000, longest=80_000, holdout=2_000_000, channel=900_000, target=6_000_000, mix={"en": 0.6, "fr": 0.4})
    clips = values(spark, rows, "row_index long, channel_id string, language string, duration_ms long")
    out = split.split(clips, values(spark, [("c1",)], "channel_id string"), limits).collect()
    train, held = sequential_split(rows, {"c1"}, limits)
    assert {r.row_index for r in out if r.split == "train"} == train
    assert {r.row_index for r in out if r.split == "holdout"} == held
    assert not {r.channel_id for r in out if r.split == "train"} & {r.channel_id for r in out if r.split == "holdout"}


def test_reports(spark):
    clips = values(spark, [(0, "big", "", 1_800_000), (1, "big", "A |\nb", 1_800_000), (2, "small", "s", 1_800_000)], "row_index long, channel_id string, title string, duration_ms long")
    top = split.top_sources(clips).collect()
    assert [(r["rank"], r.channel_id, r.title) for r in top] == [(1, "big", "A |\nb"), (2, "small", "s")]
    assert "| 1 | big | 1.00 | 2 |" in report.top_table(top)
    chosen = clips.withColumns({"split": F.lit("train"), "language": F.lit("en")})
    stats = split.stats(chosen, split.Limits(target=10_800_000)).first()
    assert stats.train_ms == 5_400_000 and stats.short and math.isclose(stats.shortfall_pct, 50)
    made = json.loads(report.stats_json(stats, hours_by_language=split.hours_by(chosen, "language")))
    assert made["hours_by_language"] == {"en": 1.5} and made["train_channels"] == 2


# cuts and batches


def test_split_long(spark):
    rows = values(spark, [("a", 20), ("b", 70), ("c", 31), ("d", 30)], "id string, duration_ms long")
    out = cuts.split_long(rows, 30).collect()
    assert {r.cut_id for r in out} == {"a", "b-p0", "b-p1", "b-p2", "c-p0", "c-p1", "d"}
    assert math.isclose(sum(r.cut_ms for r in out), 151) and max(r.cut_ms for r in out) <= 30


def merged_by_loop(rows, least, target):
    out = [(i, 1, d) for i, _, d, _ in rows if d >= least]
    by = {}
    for i, c, d, _ in rows:
        if d < least:
            by.setdefault(c, []).append((i, d))
    for items in by.values():
        lot = []
        for x in [*items, None]:
            if x:
                lot.append(x)
            total = sum(d for _, d in lot)
            if lot and (total >= target or x is None and total >= least):
                out.append((lot[0][0] if len(lot) == 1 else f"concat-{lot[0][0]}-x{len(lot)}", len(lot), total))
                lot = []
    return sorted(out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 20)), max_size=30))
def test_merge_short(spark, items):
    rows = [(f"i{n}", c, d, n) for n, (c, d) in enumerate(items)]
    out = cuts.merge_short(values(spark, rows, "id string, channel_id string, duration_ms long, row_index long"), 5, 15)
    assert sorted((r.cut_id, r.n, r.total_ms) for r in out.collect()) == merged_by_loop(rows, 5, 15)


def test_shards(spark, tmp_path):
    rows = values(spark, [(f"i{n}", n) for n in range(50)], "id string, duration_ms long")
    out = cuts.sharded(rows, 7, 6)
    got = sorted((r.position, r.shard_id) for r in out.collect())
    assert got == [(i, i // 6) for i in range(50)]
    assert [r.id for r in out.orderBy("position").collect()] != [r.id for r in cuts.sharded(rows, 8, 6).orderBy("position").collect()]
    first, again = (cuts.dealt(out.select("shard_id").distinct(), 7, e, 2, 2).collect() for e in (0, 1))
    assert sorted(r.shard_id for r in first) == list(range(9)) and {r.worker for r in first} == {0, 1, 2, 3}
    assert sorted(map(tuple, first)) != sorted(map(tuple, again))
    writers.shards(out, str(tmp_path / "s"))
    assert readers.shards(spark, str(tmp_path / "s"), [0, 8]).count() == 8
    assert cuts.summary(out).agg(F.sum("n")).first()[0] == 50


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=40))
def test_pack_batches(spark, lengths):
    rows = values(spark, list(enumerate(lengths)), "i long, n long")
    by = {}
    for r in batches.packed(rows, "n", "i", 40, window=16).collect():
        assert r.buffer == r.i // 16
        by.setdefault((r.buffer, r.batch), []).append(r.n)
    assert sorted(n for v in by.values() for n in v) == sorted(lengths)
    assert all(len(v) == 1 or len(v) * max(v) <= 40 for v in by.values())


def test_arrays(spark):
    df = values(spark, [(0, [1, 2, 3]), (0, [4]), (1, [])], "b int, v array<long>")
    out = {tuple(r.v): (r.input, r.mask) for r in batches.padded_batches(df, "v", "b").collect()}
    assert out == {(1, 2, 3): ([1, 2, 3], [1, 1, 1]), (4,): ([4, 0, 0], [1, 0, 0]), (): ([], [])}
    x = one(spark, arrays.normalized(F.array(F.lit(1.0), F.lit(3.0))))
    assert abs(x[0] + 1) < 1e-6 and abs(x[1] - 1) < 1e-6
    assert one(spark, arrays.normalized(F.array(F.lit(2.0), F.lit(2.0)))) == [0.0, 0.0]


def test_ordering(spark):
    rows = spark.range(200).withColumn("h", ordering.seeded(F.col("id"), 3))
    out = sorted((r.h, r["rank"], r.ahead) for r in ordering.sum_ahead(ordering.ranked(rows, [F.col("h")], ordering.hash_bucket(F.col("h"), 1)), "id", "h").collect())
    assert [r[1] for r in out] == list(range(200))
    total, by = 0, {r.h: r.id for r in rows.collect()}
    for h, _, ahead in out:
        assert ahead == total
        total += by[h]


# monitoring


def test_schedules(spark):
    lr = lambda s: one(spark, schedules.tri_stage_lr(F.lit(s), 5e-5, 100, 0.4, 1000))
    assert lr(0) == 0 and lr(100) == 5e-5 and lr(459) == 5e-5 and math.isclose(lr(1000), 5e-7)
    temp = lambda s: one(spark, schedules.gumbel_temperature(F.lit(s), 1.0, 0.5, 0.999))
    assert temp(0) == 1 and temp(10_000) == 0.5
    assert one(spark, schedules.accumulation_steps(F.lit(1600.0), F.lit(200.0), F.lit(100))) == 1


def test_streaks(spark):
    low, high = 3.0, 50.0
    readings = [low] * 4 + [high] + [low] * 6
    rows = values(spark, [(1, i + 1, v) for i, v in enumerate(readings)] + [(2, 1, low)], "run int, step long, v double")
    assert [tuple(r) for r in monitor.alarms(rows, "run", "v", 10.0, 5).collect()] == [(1, 10, 2)]
    m = monitor.by_interval(rows.where("run = 1"), "run", "v", 5).orderBy("interval").first()
    assert (m.n, m["last"], m.last_step) == (5, high, 5)


def test_checkpoints(spark):
    names = [(f"checkpoint-{i}", f) for i in (1, 2, 3, 10) for f in ("c", "w")] + [("checkpoint-11", "c"), ("checkpoint-12-final", "c"), ("checkpoint-12-final", "w")]
    found = monitor.checkpoints(values(spark, names, "d string, f string"), "d", "f", ["c", "w"])
    assert [r.step for r in monitor.newest_first(found).collect()] == [10, 3, 2, 1]
    assert monitor.resume_step(found).first().step == 10 and monitor.resume_step(found.where("step > 10")).first().step == 0
    assert [(r.step, r.there) for r in monitor.milestones(found, [3, 11, 2]).collect()] == [(2, True), (3, True), (11, False)]
    none = values(spark, [], "step long")
    assert monitor.usable_step(found, none) == 10 and monitor.usable_step(found, values(spark, [(10,)], "step long")) == 3 and monitor.usable_step(found, none, 2) == 2
    with pytest.raises(checks.CheckError):
        monitor.usable_step(found, none, 11)
    six = values(spark, [(i,) for i in range(1, 7)], "step long")
    assert {r.step for r in monitor.retained(six, [2, 5], 2).where("keep").collect()} == {2, 4, 5, 6}
    curve = values(spark, [(500,), (1000,), (1500,), (2000,)], "step long")
    assert monitor.trimmed(curve, 1500).count() == 3 and monitor.trimmed(curve, 0).count() == 0


def test_streaming(spark, tmp_path):
    rows = values(spark, [(1, i, 1.0 if i % 10 else 50.0) for i in range(30)], "run long, step long, v double")
    rows.coalesce(1).write.parquet(str(tmp_path / "e"))
    out = monitors.run_to_end(monitors.streak_alarms(monitors.source(spark, str(tmp_path / "e")), "run", "step", "v", 10.0, 5), "append", str(tmp_path / "a"))
    assert [tuple(r) for r in out.collect()] == [(1, 5)]
    out = monitors.run_to_end(monitors.interval_metrics(monitors.source(spark, str(tmp_path / "e")), "run", "step", "v", 10), "complete", str(tmp_path / "b"))
    assert {(r.interval, r.n, r["last"]) for r in out.collect()} == {(0, 10, 1.0), (1, 10, 1.0), (2, 10, 1.0)}
    timed = spark.range(10).select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int") * 30)).cast("timestamp_ntz").alias("ts"), F.lit("a").alias("k"))
    timed.write.parquet(str(tmp_path / "t"))
    out = monitors.run_to_end(monitors.windowed_counts(monitors.source(spark, str(tmp_path / "t")), "ts", "k"), "append", str(tmp_path / "c"))
    assert {r.n for r in out.collect()} <= {2}


# benchmark and labels


def test_bench(spark, tmp_path):
    results = [{"name": "asr_x", "status": "ok", "metrics": {"wer": 0.5}}, {"name": "asr_y", "status": "ok", "metrics": {"wer": 0.7}}, {"name": "sid", "status": "ok", "metrics": {"accuracy": 0.9}}, {"name": "sid", "status": "failed", "metrics": {"accuracy": 0.1}}, {"name": "sd_x", "status": "ok", "metrics": {"der": 1.0}}]
    (tmp_path / "m.json").write_text(json.dumps({"upstream": "u", "results": results}))
    rows = bench.exploded(readers.results(spark, [str(tmp_path / "m.json")]))
    stats = bench.family_stats(bench.main_metric(rows))
    got = {r.family: (round(r["mean"], 6), round(r["std"], 6)) for r in stats.collect()}
    assert got == {"asr": (0.6, 0.141421), "sid": (0.9, 0.0)}
    wide = bench.report(values(spark, [("u",), ("none",)], "upstream string"), stats, ["asr", "sid"]).orderBy("upstream").collect()
    assert wide[0].asr_mean is None and round(wide[1].sid_mean, 6) == 0.9
    assert "—" in report.markdown(["u", "asr"], [(r.upstream, r.asr_mean) for r in wide])
    scores = bench.proxy_score(values(spark, [(1, 0.5), (2, 0.5), (3, None)], "c int, v double"), "c", "v", True)
    best = bench.best(scores, "c", F.col("c")).first()
    assert bench.choose(scores, "c", F.col("c")) == (1, -0.5)
    with pytest.raises(checks.CheckError):
        bench.choose(scores.where("c = 3"), "c", F.col("c"))
    assert best.best == 1 and best.best_score == -0.5 and "Infinity" in bench.selection_json(scores, "c").first()[0]


def test_label_changes(spark):
    tags = "map<string,string>"
    runs = values(spark, [("r1", "old", "abc", 1, {}), ("r2", "n2", "abd", 2, {"model": "m", "original_run_name": "o"}), ("r3", "x", "zzz", 3, {})], f"id string, name string, commit string, start_time int, tags {tags}")
    out = labels.changes(labels.wanted(runs, "ab"), F.concat(F.lit("n"), F.substring("id", 2, 1)), F.create_map(F.lit("model"), F.lit("m"))).collect()
    assert [(r.id, r.new_name, r.new_tags) for r in out] == [("r1", "n1", {"model": "m", "original_run_name": "old"})]
    with pytest.raises(checks.CheckError):
        labels.changes(runs, F.lit("same"), F.create_map(F.lit("model"), F.lit("m")))


# files


def test_listing_index_and_copy(spark, tmp_path):
    root = tmp_path / "drive root"
    for name, size in (("Si/g/c/é.wav", 3), ("Si/g/c/b.WAV", 5), ("Ta/g/c/a.wav", 7), ("Ta/g/c/no.txt", 1)):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * size)
    found = readers.listing(spark, str(root), ["Si", "Ta"])
    assert [tuple(r) for r in found.collect()] == [("Si/g/c/b.WAV", 5), ("Si/g/c/é.wav", 3), ("Ta/g/c/a.wav", 7)]
    assert {r.folder: r.n for r in files.index_totals(found).collect()} == {"Si": 2, "Ta": 1}
    writers.index(found, str(tmp_path / "index"))
    assert readers.index(spark, str(tmp_path / "index")).count() == 3
    (tmp_path / "bad.tsv").write_text("path\tsize\n")
    with pytest.raises(checks.CheckError):
        readers.index(spark, str(tmp_path / "bad.tsv"))
    names = values(spark, [("Si/g/c/é.wav",), ("Ta/g/c/a.wav",), ("gone",)], "filename string")
    target = tmp_path / "raw"
    once = {r.filename: r.status for r in files.copy(names, str(root), str(target)).collect()}
    assert once == {"Si/g/c/é.wav": "copied", "Ta/g/c/a.wav": "copied", "gone": "missing"}
    (target / "Ta/g/c/a.wav").write_bytes(b"x")
    again = files.copy(names, str(root), str(target))
    rows = {r.filename: r.status for r in again.collect()}
    assert rows["Si/g/c/é.wav"] == "skipped" and (target / "Ta/g/c/a.wav").stat().st_size == 7
    total = files.rollup(files.copy(names, str(root), str(target))).first()
    assert (total.skipped, total.missing, total.bytes) == (2, 1, 10) and files.faulty(again).count() == 1


def test_manifests(spark, tmp_path):
    rows = values(spark, [("a", "f1", "d/f1", "ta"), ("b", "f2", "d/f2", None)], "id string, filename string, name_in_drive string, language string")
    writers.manifest(rows, str(tmp_path / "m"))
    assert "null" in "".join(p.read_text() for p in (tmp_path / "m").glob("part*"))
    back = readers.manifest(spark, [str(tmp_path / "m")])
    cutset = readers.manifest_cuts(back, rows.select("filename"))
    assert {r.id: r.custom["language"] for r in cutset.collect()} == {"a": "ta", "b": "unknown"}
    assert [r[0] for r in readers.manifest_names(spark, [str(tmp_path / "m")] * 2).collect()] == ["f1", "f2"]
    for bad in (rows.union(rows), rows.withColumn("name_in_drive", F.lit(None).cast("string"))):
        with pytest.raises(checks.CheckError):
            writers.manifest(bad, str(tmp_path / "n"))
    with pytest.raises(checks.CheckError, match="f2"):
        readers.manifest_cuts(back, rows.where("id = 'a'").select("filename"))
    (tmp_path / "block.txt").write_text(" c1 \n\nc2\n")
    assert {r[0] for r in readers.blocklist(spark, str(tmp_path / "block.txt")).collect()} == {"c1", "c2"}
    assert readers.blocklist(spark, None).count() == 0


# reports, barriers and restarts


PRETRAIN = """
pretrain:
  base_model: some/model
  max_updates: 13500
  warmup_updates: 1000
  peak_lr: 5.0e-5
  hold_ratio: 0.4
  adam_betas: [0.9, 0.98]
  adam_eps: 1.0e-6
  weight_decay: 0.01
  max_grad_norm: 1.0
  target_batch_seconds: 1600
  per_device_max_seconds: 200
  num_workers: 4
  mask_time_prob: 0.65
  mask_time_length: 10
  diversity_loss_weight: 0.1
  max_gumbel_temperature: 1.0
  min_gumbel_temperature: 0.5
  gumbel_temperature_decay: 0.999995
  save_every_updates: 1500
  eval_every_updates: 500
  keep_last_n_checkpoints: 5
  milestone_checkpoints: [4500, 9000, 13500]
  output_dir: models/new
monitoring:
  consecutive_alerts: 3
tracker:
  uri: x
"""


def test_settings_of_a_run(tmp_path):
    import yaml

    (tmp_path / "params.yaml").write_text(PRETRAIN)
    made = params.Params.from_yaml(str(tmp_path / "params.yaml"))
    assert made.pretrain.milestone_checkpoints == (4500, 9000, 13500) and made.pretrain.precision == "bf16"
    assert made.monitoring.consecutive_alerts == 3 and made.monitoring.perplexity_floor == 10 and made.other == {"tracker": {"uri": "x"}}
    base = yaml.safe_load(PRETRAIN)["pretrain"]
    for bad in ({"max_updates": -5}, {"max_updates": 0}, {"max_updates": 1.5}, {"max_updates": "9"}, {"adam_eps": 0}, {"mask_time_prob": 1.1}, {"weight_decay": -1}, {"max_gpu_memory_fraction": 0}, {"gumbel_temperature_decay": 2}, {"keep_last_n_checkpoints": 0}, {"num_workers": -1}, {"precision": "int8"}, {"unknown": 1}, {"freeze_feature_encoder": 1}):
        with pytest.raises(ValueError):
            params.Params.of({"pretrain": base | bad})
    for name in ("peak_lr", "output_dir", "milestone_checkpoints"):
        with pytest.raises(ValueError, match=name):
            params.Params.of({"pretrain": {k: v for k, v in base.items() if k != name}})
    with pytest.warns(UserWarning):
        params.Params.of({"pretrain": base | {"precision": "fp16"}})
    assert params.Params.of({}).monitoring.consecutive_alerts == 5
    for bad in ({"perplexity_floor": 0}, {"floor": 3}, None):
        with pytest.raises(ValueError):
            params.Params.of({"monitoring": bad})


def test_catalog_metadata(spark, tmp_path):
    rows = values(spark, [("a", "sinhala", "Yes"), ("b", "tamil", "no"), ("c", "tamil", "yes")], "source_id string, language string, to_train string")
    writers.catalog(rows, str(tmp_path / "out"), ["source_id"], datetime(2025, 1, 2))
    for _ in range(2):
        assert json.loads((tmp_path / "out" / "catalog_meta.json").read_text()) == {"timestamp": "20250102T000000Z", "total_rows": 3, "sinhala_rows": 1, "tamil_rows": 2, "to_train_rows": 2}
        from sluice.shared import put

        put(spark, str(tmp_path / "out" / "catalog_meta.json"), (tmp_path / "out" / "catalog_meta.json").read_text())
    assert not [p for p in (tmp_path / "out").iterdir() if ".part-" in p.name and not p.name.startswith(".")]


def test_benchmark_report(spark):
    rows = values(spark, [("u", 0.6, 0.1414, None, None)], "upstream string, asr_mean double, asr_std double, sid_mean double, sid_std double").collect()
    text, table = report.benchmark(rows, {"u": "Mine", "none": "Other"}, ["asr", "sid"], [0, 1])
    assert "| Mine | 0.600 ± 0.141 | — |" in text and "| Other | — | — |" in text
    assert table.splitlines() == ["upstream,ASR_mean,ASR_std,SID_mean,SID_std", "Mine,0.6,0.1414,,", "Other,,,,"]


def test_selection_report(spark):
    clips = values(spark, [(0, "big", "A |\nb", 1_800_000), (1, "big", "x", 1_800_000), (2, "small", "s", 1_800_000)], "row_index long, channel_id string, title string, duration_ms long")
    chosen = clips.withColumns({"split": F.lit("train"), "language": F.lit("en")})
    stats = split.stats(chosen, split.Limits(target=10_800_000)).first()
    cleaning = {"marked": 1234, "repeats": 5, "ambiguous": 1, "candidates": 1228}
    genres = split.top_by_hours(chosen.withColumn("genre", F.when(F.col("row_index") == 0, "z").otherwise("a")), "genre").collect()
    tied = split.top_by_hours(chosen.where("row_index > 0").withColumn("genre", F.concat(F.lit("g"), (-F.col("row_index")).cast("string"))), "genre").collect()
    text = report.selection(stats, 3.0, split.hours_by(chosen, "language").collect(), genres, split.top_sources(chosen).collect(), 0, cleaning)
    for line in ("| train | 1.50 | 3 | 2 |", "| holdout | 0.00 | 0 | 0 |", "| marked | 1234 |", "| ambiguous | 1 |", "| en | 1.50 |", "| 1 | big | 1.00 | 66.7% | 2 | A \\| b |", "falls short by 50.0 %"):
        assert line in text, line
    assert text.index("| a | 1.00 |") < text.index("| z | 0.50 |")
    assert [r.genre for r in tied] == ["g-1", "g-2"]  # ties by first row
    assert "catalog" not in report.selection(stats, 3.0, [], tied, [], 0)


def test_selection_of_a_checkpoint(spark):
    scores = values(spark, [(9000, 0.9), (4500, 0.91)], "c long, score double")
    assert json.loads(bench.selection(scores, "c", F.col("c"), "asr", 0)) == {"proxy_task": "asr", "proxy_seed": 0, "best_checkpoint": "9000", "best_score": 0.9, "all_scores": {"4500": 0.91, "9000": 0.9}}


def test_barriers_of_cuts(spark):
    rows = values(spark, [(30_005.0, 16_000), (12.0, 16_000)], "cut_ms double, sampling_rate int")
    assert cuts.refuse_too_long(rows, 30_000).count() == 2 and cuts.refuse_other_rates(rows, 16_000).count() == 2
    with pytest.raises(checks.CheckError):
        cuts.refuse_too_long(rows, 29_990)
    for bad in ((1.0, 8_000), (1.0, None)):
        with pytest.raises(checks.CheckError):
            cuts.refuse_other_rates(rows.union(values(spark, [bad], "cut_ms double, sampling_rate int")), 16_000)


def test_batch_order(spark):
    rows = values(spark, [(i, 10 + i) for i in range(600)], "doc_id long, n long")
    got = batches.dealt(batches.packed(rows, "n", "doc_id", 3000), 7).collect()
    for buffer in (0, 1, 2):
        pairs = {(r.batch, r.position) for r in got if r.buffer == buffer}
        assert sorted(p for _, p in pairs) == list(range(len(pairs))) and len({b for b, _ in pairs}) == len(pairs)
    assert any(r.batch != r.position for r in got)


def test_interval_report(spark):
    rows = [(1, s, float(s), None if s < 5 else 2.0, 1.0, 100.0 + 2 * s) for s in range(1, 8)]
    out = [tuple(r) for r in monitor.interval_report(values(spark, rows, "run int, step long, loss double, extra double, grad double, at double"), "run", 3, ["loss", "extra"], "grad", "loss", "at").orderBy("step").collect()]
    assert out == [(1, 3, 2.0, 0.0, 1.0, 6 / 4), (1, 6, 5.0, 2.0, 1.0, 15 / 6)]


def test_streak_across_restarts(spark, tmp_path):
    """A streak that begins in one run of the stream ends in the next, which goes on from the progress folder."""
    rows = lambda steps: values(spark, [(1, s, 3.0) for s in steps] + [(2, s, 50.0) for s in steps], "run long, step long, v double")
    folder, got = str(tmp_path), []
    for i, steps in enumerate(([1, 2, 3], [4], [5, 6], [7])):
        rows(steps).write.parquet(f"{folder}/in/lot-{i}")
        stream = monitors.streak_alarms(monitors.arriving(spark, f"{folder}/in", rows([1])), "run", "step", "v", 10.0, 5)
        got.append([tuple(r) for r in monitors.run_to_end(stream, "append", folder).collect()])
    assert got == [[], [], [(1, 5)], [(1, 5)]]


def test_split_plan_is_small(spark):
    """The clips are read twice and no fold is left in the plan of a split."""
    from sluice.plans.queries import select_split

    plan = select_split(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 10 and plan.count("MapInArrow") + plan.count("MapInPandas") == 0


def test_checkpoint_is_whole_or_absent(spark, tmp_path):
    root, needed = str(tmp_path), ["trainer.json", "model.json"]
    made = writers.checkpoint(spark, root, 30, {n: "{}" for n in needed}, {"curve": spark.range(3)})
    assert made == f"{root}/checkpoint-30" and spark.read.parquet(f"{made}/curve").count() == 3
    writers.checkpoint(spark, root, 30, {"trainer.json": '{"step": 30}', "model.json": "{}"})
    assert json.loads((tmp_path / "checkpoint-30" / "trainer.json").read_text()) == {"step": 30}
    assert not (tmp_path / "checkpoint-30" / "curve").exists()
    with pytest.raises(Exception):
        writers.checkpoint(spark, root, 60, {"trainer.json": None, "model.json": "{}"})
    assert [p.name for p in tmp_path.iterdir()] == ["checkpoint-30"]
    found = monitor.checkpoints(readers.checkpoint_listing(spark, root), "folder", "file", needed)
    assert [tuple(r) for r in found.collect()] == [(30, True)]

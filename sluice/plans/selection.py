"""From a catalog and a file index to the split: manifests, the list of unresolved rows, statistics and a report, in one call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.checks import require_rows
from sluice.functions.text import clip_id
from sluice.operators import catalog, report, resolve, split
from sluice.params import SelectParams
from sluice.shared import discard, located, put, saved
from sluice.sources import readers, writers

#: Columns that a catalog may lack, and what stands for them then.
DEFAULTS = {"language": "unknown", "genre": "unknown", "speaking_style": "unknown", "language_formality": "unknown", "code_switching": "unknown", "title": "", "source_url": ""}
MANIFEST = ["id", "filename", "name_in_drive", "language", "duration", "genre", "speaking_style", "language_formality", "code_switching", "channel_id"]


@dataclass(frozen=True)
class Selection:
    """The written tables: all chosen clips with split, and where the files are."""

    chosen: DataFrame
    train: str
    holdout: str
    unresolved: str
    report: str
    stats: str


def limits_of(settings: SelectParams) -> split.Limits:
    ms = lambda hours: round(hours * 3_600_000)
    return split.Limits(settings.seed, round(settings.min_segment_seconds * 1000), round(settings.max_segment_seconds * 1000), ms(settings.holdout_hours), ms(settings.max_hours_per_channel), ms(settings.target_hours), dict(settings.language_mix))


def candidates(rows: DataFrame, index: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The catalog's rows (as ``catalog.load`` gives them) with status and path, repeats left out, as a written table; and how many rows became what."""
    n = rows.count()
    keys = [F.lower("language"), F.col("channel_id"), F.col("filename"), F.col("size_bytes")]
    once = resolve.first_of_each(rows, keys, "row_index")
    same = (F.lower("language") == F.col("k_language")) & (F.col("genre") == F.col("k_genre")) & (F.col("filename") == F.col("k_filename")) & (F.col("size_bytes") == F.col("k_size"))
    out = saved(resolve.resolve(once, resolve.path_lookup(index), same, "row_index").drop("n", "k_language", "k_genre", "k_filename", "k_size"), "resolved")
    found = resolve.summary(out).first().asDict()
    return out, {"marked for training": n, "repeats left out": n - sum(found.values()), **{f"unresolved: {r}": found[r] for r in resolve.REASONS}, "candidates": found["resolved"]}


def typed(raw: DataFrame) -> DataFrame:
    """A catalog's text columns as the rows to train on; row_index follows the order in which its rows are read."""
    rows = catalog.load(raw.withColumn("__nth", F.monotonically_increasing_id()), F.col("__nth"), defaults=DEFAULTS)
    own = ["row_index", "language", "genre", "speaking_style", "language_formality", "code_switching", "title", "source_url", "size_bytes", "duration_seconds"]
    return rows.select(*own, F.col("name_in_drive").alias("filename"), F.trim("source_id").alias("channel_id"), F.round(F.col("duration_seconds") * 1000).cast("long").alias("duration_ms"))


def run(spark: SparkSession, settings: SelectParams, out: str) -> Selection:
    """Reads the catalog, the index and the list of blocked channels (none if it isn't there) that settings name, and writes below out.

    manifests/train and manifests/dev (JSON lines), reports/unresolved_clips (CSV), reports/selection_stats.json and reports/selection_report.md. A
    catalog without rows to train on, one of which no row has a file, blank source ids, and repeated ids are errors; manifests
    are published whole or not at all.
    """
    rows = require_rows(saved(typed(readers.csv(spark, settings.catalog_path)), "catalog"), "no row of the catalog is to be trained on")
    resolved, cleaning = candidates(rows, readers.index(spark, settings.drive_index_path))
    good = require_rows(resolved.where("status = 'resolved'"), "no row of the catalog has a file of its own")
    writers.unresolved(resolved, f"{out}/reports/unresolved_clips", ["filename", "language", "genre", "channel_id", "size_bytes", "row_index"])
    fs, at = located(spark, settings.exclude_channels_file) if settings.exclude_channels_file else (None, None)
    blocked = readers.blocklist(spark, settings.exclude_channels_file if fs and fs.exists(at) else None)
    limits = limits_of(settings)
    chosen = saved(split.split(good, blocked, limits), "chosen")
    named = chosen.withColumns({"id": clip_id(F.col("path")), "name_in_drive": F.col("filename"), "filename": F.col("path"), "duration": F.col("duration_seconds")})
    paths = {side: f"{out}/manifests/{name}" for side, name in (("train", "train"), ("holdout", "dev"))}
    for side, path in paths.items():
        writers.manifest(named.where(F.col("split") == side).select(MANIFEST), path, path_col="filename")
    stats, overlap = split.stats(chosen, limits).first(), split.overlap(chosen).first().overlap
    languages, genres = split.hours_by(chosen, "language"), split.hours_by(chosen, "genre")
    train = chosen.where("split = 'train'")
    text = report.selection(stats, settings.target_hours, languages.collect(), split.top_by_hours(chosen, "genre").collect(), split.top_sources(train).collect(), overlap, cleaning)
    put(spark, f"{out}/reports/selection_report.md", text)
    put(spark, f"{out}/reports/selection_stats.json", report.stats_json(stats, cleaning, hours_by_language=languages, hours_by_genre=genres))
    discard(rows, resolved)
    return Selection(chosen, paths["train"], paths["holdout"], f"{out}/reports/unresolved_clips", f"{out}/reports/selection_report.md", f"{out}/reports/selection_stats.json")

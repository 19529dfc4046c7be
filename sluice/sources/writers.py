"""Writers: dated catalogs, indexes, manifests, shards, reports, curves."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.checks import published, require_columns
from sluice.operators.catalog import metadata
from sluice.operators.cuts import too_long
from sluice.shared import discard, located, put, saved

#: CSV keeps white space at the ends of cells.
WHOLE = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: How the names of checkpoints begin that are being written.
UNFINISHED = ".checkpoint-"
#: The column that tells a curve's bucket of runs.
BUCKET = "run_bucket"


def catalog(df: DataFrame, folder: str, required: list[str], now: datetime | None = None) -> str:
    """Writes the catalog to a dated folder and to latest, and its counters to catalog_meta.json; returns the dated folder."""
    require_columns(df, required)
    stamp = f"{(now or datetime.now(UTC)):%Y%m%dT%H%M%SZ}"
    path = f"{folder}/catalog_{stamp}"
    df.write.csv(path, quote='"', escape='"', emptyValue="", **WHOLE)
    written = df.sparkSession.read.csv(path, header=True, multiLine=True, quote='"', escape='"').na.fill("")
    published(written, f"{folder}/catalog_latest", lambda rows, at: rows.write.csv(at, quote='"', escape='"', emptyValue="", **WHOLE))
    if {"language", "to_train"} <= set(df.columns):
        rows = {r["language"]: r for r in metadata(written.na.fill(""), "language", "to_train").collect()}  # one row a language
        meta = {"timestamp": stamp, "total_rows": rows[None].total if None in rows else 0}
        meta |= {f"{k}_rows": r.total for k, r in sorted(rows.items(), key=str) if k} | {"to_train_rows": rows[None].to_train if None in rows else 0}
        put(df.sparkSession, f"{folder}/catalog_meta.json", json.dumps(meta, indent=2))
    return path


def index(df: DataFrame, path: str) -> None:
    """The index by relpath, in as many part files as its size asks for, each with the header; parts and their lines ascend."""
    df.select("relpath", "size").repartitionByRange("relpath").sortWithinPartitions("relpath").write.mode("overwrite").csv(path, sep="\t", quote="", **WHOLE)


def manifest(df: DataFrame, path: str, id_col: str = "id", path_col: str = "name_in_drive") -> None:
    """JSON lines with all fields; with a row without a path or a repeated id nothing is published."""
    published(df, path, lambda rows, at: rows.write.option("ignoreNullFields", False).json(at), {"rows without a path": F.coalesce(path_col, F.lit("")) == ""}, id_col)


def unresolved(df: DataFrame, path: str, columns: list[str], order: str = "row_index") -> None:
    df.where("status <> 'resolved'").orderBy(order).select(F.col("status").alias("reason"), *columns).write.mode("overwrite").csv(path, quote='"', escape='"', **WHOLE)


def shards(df: DataFrame, path: str, most: float | None = None, length: str = "cut_ms") -> None:
    """A folder for each shard_id; what a shard holds is written by one task. With a cut longer than most nothing is published."""
    rules = {} if most is None else {f"cuts longer than {most} ms": too_long(F.col(length), most)}
    dealt = df.repartition("shard_id").sortWithinPartitions("shard_id", "position")
    published(dealt, path, lambda rows, at: rows.write.partitionBy("shard_id").parquet(at), rules)


def curve(df: DataFrame, path: str, run: str = "run", interval: str = "interval", buckets: int | None = None) -> None:
    """Readings of a curve: a run's intervals that are written again replace what was there, all others stay.

    A folder a run and interval; with buckets a folder an interval and bucket of runs, so that many runs don't make as many
    folders. The readings of other runs in a bucket are then written again with the new ones. A path keeps its number of buckets.
    """
    if not buckets:
        by_folder(df, path, [run, interval])
        return
    folders, columns = [interval, BUCKET], [*df.columns, BUCKET]
    new = saved(df.withColumn(BUCKET, F.pmod(F.xxhash64(run), F.lit(buckets)).cast("int")), "curve")
    stay, (fs, at) = None, located(df.sparkSession, path)
    if fs.exists(at):
        old = df.sparkSession.read.schema(new.schema).parquet(path)
        again = new.select(*(F.col(c).alias(f"__{c}") for c in (run, interval))).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (run, interval)]
        touched = new.select(*(F.col(c).alias(f"__{c}") for c in folders)).distinct()
        there = old.join(F.broadcast(touched), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in folders], "left_semi")
        stay = saved(there.join(again, same, "left_anti").select(columns), "curve")
    by_folder(new if stay is None else new.unionByName(stay), path, folders)
    discard(*(x for x in (new, stay) if x is not None))


def by_folder(df: DataFrame, path: str, folders: list[str]) -> None:
    """Each folder that df has rows of is replaced; one task writes it."""
    df.repartition(*folders).sortWithinPartitions(*folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def trim_curve(spark: SparkSession, path: str, resume: int, step: str = "step", run: str = "run", interval: str = "interval") -> None:
    """Takes the steps behind the one that runs resume from out of a written curve, in folders of either kind; 0 takes all. Only folders that have such steps are touched."""
    fs, at = located(spark, path)
    if not fs.exists(at):
        return
    rows = spark.read.parquet(path)
    folders = [interval, BUCKET] if BUCKET in rows.columns else [run, interval]
    stale = rows.where((F.col(step) > resume) | F.lit(resume == 0)).select(folders).distinct()
    stale = saved(stale, "stale")
    keep = rows.join(F.broadcast(stale), folders).where((F.col(step) <= resume) & F.lit(resume != 0))
    keep = saved(keep, "trimmed")
    rest = stale.join(keep.select(folders).distinct(), folders, "left_anti")
    by_folder(keep.select(rows.columns), path, folders)
    for r in rest.toLocalIterator():  # folders of which nothing stays
        fs.delete(located(spark, f"{path}/{folders[0]}={r[0]}/{folders[1]}={r[1]}")[1], True)
    discard(stale, keep)


def text(content: str, path: str, spark) -> None:
    """A small report as one text file."""
    spark.createDataFrame([(content.rstrip("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def checkpoint(spark: SparkSession, folder: str, step: int, files: dict[str, str], tables: dict[str, DataFrame] | None = None) -> str:
    """Small files and tables as folder/checkpoint-<step>: made under another name, then renamed, so that it is there whole or not at all.

    An older checkpoint of the step stays until the new one is whole. Names that begin
    with a dot are left out by the listing, so what a stopped run leaves behind is no checkpoint.
    """
    part, to = f"{folder}/{UNFINISHED}{step}-{uuid.uuid4().hex}", f"{folder}/checkpoint-{step}"
    fs, made = located(spark, part)
    fs.mkdirs(made)
    try:
        for name, df in (tables or {}).items():
            df.write.parquet(f"{part}/{name}")
        for name, content in files.items():
            put(spark, f"{part}/{name}", content)
        _, at = located(spark, to)
        fs.delete(at, True)
        if not fs.rename(made, at):
            raise OSError(f"{to} could not be written")
    except BaseException:
        fs.delete(made, True)
        raise
    return to

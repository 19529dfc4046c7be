"""Copying listed files: plan, idempotent copy, rollup."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.ordering import placed
from sluice.shared import files_at, saved


def plan(wanted: DataFrame, source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """wanted with status and bytes: missing in the source, skipped where the target has the size, else copied. source and target have key, size."""
    s = source.select(F.col(key).alias("__s"), F.col("size").alias("__ss"))
    t = target.select(F.col(key).alias("__t"), F.col("size").alias("__ts"))
    out = wanted.join(s, F.col(key) == F.col("__s"), "left").join(t, F.col(key) == F.col("__t"), "left")
    status = F.when(F.col("__ss").isNull(), "missing").when(F.col("__ss") == F.col("__ts"), "skipped").otherwise("copied")
    return out.withColumns({"status": status, "bytes": F.coalesce("__ss", F.lit(0)).cast("long")}).drop("__s", "__ss", "__t", "__ts")


def write(rows: DataFrame, root: str, name: str, content: str) -> DataFrame:
    """name and bytes of each row's content (binary; null: empty), written below root by the executors, each under another name and then moved into place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = files_at(root)
        for batch in batches:
            sizes, names = [], batch.column(0).to_pylist()
            for path, data in zip(names, batch.column(1).to_pylist(), strict=True):
                to = f"{base}/{path}"
                fs.create_dir(to.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(part := f"{to}.{uuid.uuid4().hex}.part") as f:
                    f.write(data or b"")
                fs.move(part, to)
                sizes.append(len(data or b""))
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64())], names=[name, "bytes"])

    return rows.select(name, content).mapInArrow(run, f"`{name}` string, bytes long")


def copy_one(source: pafs.FileSystem, at: str, target: pafs.FileSystem, to: str) -> tuple[str, int, str | None]:
    """Copies through a .part file and a move; a target of the same size stays as it is."""
    try:
        there, old = source.get_file_info(at), target.get_file_info(to)
        if there.type != pafs.FileType.File:
            return "missing", 0, None
        if old.type == pafs.FileType.File and old.size == there.size:
            return "skipped", there.size, None
        target.create_dir(to.rpartition("/")[0], recursive=True)
        part = f"{to}.{uuid.uuid4().hex}.part"
        with source.open_input_stream(at) as data, target.open_output_stream(part) as out:
            while chunk := data.read(8 << 20):
                out.write(chunk)
        if target.get_file_info(part).size != there.size:
            target.delete_file(part)
            return "failed", 0, "size differs"
        try:
            target.move(part, to)
        except OSError:
            target.delete_file(part)
            raise
    except OSError as e:
        return "failed", 0, str(e)
    return "copied", there.size, None


def binned(names: DataFrame, size: str, key: str, bins: int) -> DataFrame:
    """names with bin: the longest first, dealt to and fro over the bins, so that all have about the same bytes."""
    ranked = placed(names, [F.col(size).desc_nulls_last(), F.col(key)], "__rank")
    nth, turn = F.col("__rank") % bins, F.floor(F.col("__rank") / bins) % 2
    return ranked.withColumn("bin", F.when(turn == 0, nth).otherwise(bins - 1 - nth).cast("int")).drop("__rank")


def copy(names: DataFrame, source_root: str, target_root: str, name: str = "filename", size: str | None = None, bins: int | None = None) -> DataFrame:
    """name, status, bytes, error of each file, copied by the executors. Roots are paths that all executors see, or URIs that pyarrow.fs knows.

    size: a column with the files' bytes; the files are then dealt to ``bins`` tasks (as many as there are shuffle partitions) of about the same bytes.
    """
    bins = bins or int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (source, a), (target, b) = files_at(source_root), files_at(target_root)
        for batch in batches:
            rows = [copy_one(source, f"{a}/{n}", target, f"{b}/{n}") for n in batch.column(0).to_pylist()]
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True))], names=[name, "status", "bytes", "error"])

    dealt = names.select(name) if size is None else binned(names.select(name, size), size, name, bins).repartitionById(bins, "bin").select(name)
    return dealt.mapInArrow(run, f"`{name}` string, status string, bytes long, error string")


def copy_until_done(names: DataFrame, source_root: str, target_root: str, name: str = "filename", size: str | None = None, tries: int = 3) -> DataFrame:
    """What ``copy`` gives, after files that failed were tried again, up to tries times in all; each round's list is written."""
    done, todo = None, names
    for i in range(tries):
        round_ = saved(copy(todo, source_root, target_root, name, size if i == 0 else None), "copied")
        last = i + 1 == tries or round_.where("status = 'failed'").isEmpty()
        part = round_ if last else round_.where("status <> 'failed'")
        done = part if done is None else done.unionByName(part)
        if last:
            break
        todo = round_.where("status = 'failed'").select(name)
    return done


def rollup(copied: DataFrame) -> DataFrame:
    """One row: how many of each status, and bytes and GB of what is in place."""
    there = F.sum(F.when(F.col("status").isin("copied", "skipped"), F.col("bytes")))
    return copied.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("copied", "skipped", "missing", "failed")), F.coalesce(there, F.lit(0)).alias("bytes"), (F.coalesce(there, F.lit(0)) / 1e9).alias("gb"))


def faulty(copied: DataFrame) -> DataFrame:
    """What a run must answer for with a failure."""
    return copied.where(F.col("status").isin("missing", "failed"))


def index_totals(index: DataFrame, path: str = "relpath") -> DataFrame:
    """Files and GB of each top folder."""
    return index.groupBy(F.split(path, "/")[0].alias("folder")).agg(F.count("*").alias("n"), (F.sum("size") / 1e9).alias("gb"))

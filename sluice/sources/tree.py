"""Listings of large trees, walked by the executors from a work list of folders."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.checks import CheckError, require_none
from sluice.shared import files_at, fresh_path

#: A task hands its other folders back after so many entries.
ENTRIES = 20_000
FOUND = "path string, size long, open boolean"


def listed(fs: pafs.FileSystem, folder: str) -> Iterator[tuple[str, int, bool]]:
    """path, size and whether it is a folder of what lies in a folder; symbolic links are left out."""
    local = isinstance(fs, pafs.LocalFileSystem)
    for info in fs.get_file_info(pafs.FileSelector(folder)):
        if info.type in (pafs.FileType.File, pafs.FileType.Directory) and not (local and os.path.islink(info.path)):
            yield info.path, info.size or 0, info.type == pafs.FileType.Directory


def walk(spark: SparkSession, root: str, folders: list[str], suffix: str = "wav", entries: int = ENTRIES) -> DataFrame:
    """relpath and size of all files below folders of root whose names end in .suffix, in either case, by relpath.

    root: a path or a URI that pyarrow.fs knows and all executors reach. The folders that are still to be
    listed are dealt evenly to the tasks, round after round; a task goes down its folders until it
    has seen ``entries`` entries, then hands the rest back, so that neither a deep branch nor a wide one keeps
    one task busy. Names that begin with _ or . count like others, empty folders give nothing, symbolic links
    aren't followed. A folder of ``folders`` that isn't there, and tabs or line ends in a path, are errors.
    """
    fs, base = files_at(root)
    for info in fs.get_file_info([f"{base}/{f}" for f in folders]):
        if info.type != pafs.FileType.Directory:
            raise CheckError(f"{info.path} is no folder")
    end, at, level = f".{suffix.lower()}", fresh_path(spark, "tree"), 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = files_at(root)
        todo, seen, rows = [p for b in batches for p in b.column(0).to_pylist()], 0, []
        while todo and seen < entries:
            for path, size, is_folder in listed(own, todo.pop()):
                seen += 1
                if is_folder:
                    todo.append(path)
                elif path.lower().endswith(end):
                    rows.append((path, size, False))
                if len(rows) >= 10_000:
                    yield as_batch(rows)
                    rows = []
        yield as_batch(rows + [(path, 0, True) for path in todo])

    def as_batch(rows: list[tuple[str, int, bool]]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()), strict=True)], names=["path", "size", "open"])

    tasks = spark.sparkContext.defaultParallelism
    work, open_folders = spark.createDataFrame([(f"{base}/{f}",) for f in sorted(set(folders))], "path string"), len(set(folders))
    while open_folders:
        dealt = work.repartition(min(open_folders, 4 * tasks))
        dealt.mapInArrow(run, FOUND).write.parquet(f"{at}/round={level}")
        work = spark.read.schema(FOUND).parquet(f"{at}/round={level}").where("open").select("path")
        open_folders, level = work.count(), level + 1
    found = spark.read.schema(FOUND).parquet(f"{at}/round=*") if level else spark.createDataFrame([], FOUND)
    out = found.where("not open").select(F.substr("path", F.lit(len(base) + 2)).alias("relpath"), "size")
    require_none(out, F.col("relpath").rlike(r"[\t\r\n]"), "tabs or line ends in paths")
    return out.orderBy("relpath")

"""Shards as tar archives: a data source that writes an archive a shard, and reads archives back.

An item is two members, ``<id>.<extension>`` with its payload and ``<id>.json`` with its other
columns. Tasks write below a folder of the job's own; only when all have ended does the driver move the
archives into place, and when one fails it removes that folder, so a failed write leaves nothing.
"""

from __future__ import annotations

import io
import json
import re
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from sluice.shared import files_at

ITEMS = T.StructType([T.StructField("shard_id", T.LongType()), T.StructField("position", T.LongType()), T.StructField("id", T.StringType()), T.StructField("payload", T.BinaryType()), T.StructField("meta", T.StringType())])
NAME = re.compile(r"shard-(\d+)\.tar(\.gz)?")


def archive_name(shard: int, compression: str | None = None) -> str:
    return f"shard-{shard:06d}.tar" + (".gz" if compression else "")


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: shard, and the archive's path in the job's folder."""

    archives: list[tuple[int, str]]


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.extension, self.overwrite = options["path"], options.get("extension", "bin"), overwrite
        self.compression = options.get("compression") or None
        if self.compression not in (None, "gzip"):
            raise ValueError(f"compression must be gzip or none, got {self.compression}")
        self.job = f"{self.path.rstrip('/')}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, job = files_at(self.job)
        fs.create_dir(job, recursive=True)
        archives, shard, tar, stream = [], None, None, None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if row["shard_id"] != shard or tar is None:
                        if tar is not None:
                            tar.close()
                            stream.close()
                        shard = row["shard_id"]
                        if shard is None or shard < 0:
                            raise ValueError(f"{shard} is no number of a shard")
                        to = f"{job}/{archive_name(shard)}.{uuid.uuid4().hex}"
                        archives.append((shard, to))
                        stream = fs.open_output_stream(to, compression=self.compression)
                        tar = tarfile.open(fileobj=stream, mode="w|", format=tarfile.PAX_FORMAT)
                    rest = {k: v for k, v in row.items() if k not in ("shard_id", "id", "payload")}
                    for name, data in ((f"{row['id']}.{self.extension}", row["payload"] or b""), (f"{row['id']}.json", json.dumps(rest, ensure_ascii=False, default=str).encode())):
                        member = tarfile.TarInfo(name)
                        member.size = len(data)
                        tar.addfile(member, io.BytesIO(data))
            if tar is not None:
                tar.close()
        finally:
            if stream is not None:
                stream.close()
        return Written(archives)

    def commit(self, messages: list[Written | None]) -> None:
        """Moves all archives into place. A shard that two tasks have written is an error: its rows must be dealt to one."""
        fs, folder = files_at(self.path)
        found = [x for m in messages if m for x in m.archives]
        numbers = [shard for shard, _ in found]
        if twice := sorted({n for n in numbers if numbers.count(n) > 1} if len(set(numbers)) < len(numbers) else ()):
            self.abort(messages)
            raise ValueError(f"shards {twice[:5]} were written in several parts")
        there = {m[1]: i.path for i in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if (m := NAME.fullmatch(i.base_name))}
        if not self.overwrite and (both := [n for n in numbers if f"{n:06d}" in there]):
            self.abort(messages)
            raise ValueError(f"shards {both[:5]} are there already")
        fs.create_dir(folder, recursive=True)
        for shard, at in found:
            fs.move(at, f"{folder}/{archive_name(shard, self.compression)}")
        if self.overwrite:
            for path in set(there.values()) - {f"{folder}/{archive_name(n, self.compression)}" for n in numbers}:
                fs.delete_file(path)
        self.clear()

    def abort(self, messages: list[Written | None]) -> None:
        self.clear()

    def clear(self) -> None:
        fs, job = files_at(self.job)
        if fs.get_file_info(job).type == pafs.FileType.Directory:
            fs.delete_dir(job)


@dataclass
class Archive(InputPartition):
    shard: int
    path: str


class Reader(DataSourceReader):
    """A partition an archive. Filters on shard_id choose the archives that are opened."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.wanted = options["path"], None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("shard_id",):
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> list[Archive]:
        fs, folder = files_at(self.path)
        there = {int(m[1]): i.path for i in fs.get_file_info(pafs.FileSelector(folder)) if (m := NAME.fullmatch(i.base_name))}
        return [Archive(n, path) for n, path in sorted(there.items()) if self.wanted is None or n in self.wanted] or [Archive(-1, "")]

    def read(self, partition: Archive) -> Iterator[tuple]:
        if not partition.path:
            return
        fs, _ = files_at(self.path)
        with fs.open_input_stream(partition.path, compression="gzip" if partition.path.endswith(".gz") else None) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
            payload, position = None, 0
            for member in tar:
                data = tar.extractfile(member).read()
                if payload is None:
                    payload = member.name.rpartition(".")[0], data
                else:
                    yield partition.shard, position, payload[0], payload[1], data.decode()
                    payload, position = None, position + 1


class Archives(DataSource):
    """Options: path (a folder, or a URI that pyarrow.fs knows), extension, compression (gzip, or none)."""

    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> T.StructType:
        return ITEMS

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def write_archives(items: DataFrame, path: str, order: str = "position", extension: str = "bin", overwrite: bool = False, compression: str | None = None) -> None:
    """items (shard_id, id, payload, and other columns, which go to the JSON) as an archive a shard, in order.

    Shards are dealt to tasks by their number, so each is one task's; a null or negative number is an error. Null payloads are empty. compression: gzip suits texts, and makes them <archive>.tar.gz.
    """
    spark = items.sparkSession
    spark.dataSource.register(Archives)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.coalesce(F.pmod(F.col("shard_id"), F.lit(parts)), F.lit(0)).cast("int")
    dealt = items.withColumn("shard_id", F.col("shard_id").cast("long")).repartitionById(parts, number).sortWithinPartitions("shard_id", order)
    dealt.write.format("archives").mode("overwrite" if overwrite else "append").option("path", path).option("extension", extension).option("compression", compression or "").save()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """shard_id, position, id, payload and meta (JSON) of all items; of filters on shard_id only the wanted archives are opened."""
    spark.dataSource.register(Archives)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("archives").load(path)

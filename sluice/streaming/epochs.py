"""Written shards as a stream of epochs: each epoch deals all shards anew, and a stopped stream goes on where it was."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sluice.shared import files_at

FOLDER = re.compile(r"shard_id=(\d+)")
#: A task reads so many shards of one worker at most.
TOGETHER = 32


def dealt_order(shards: list[int], seed: int, epoch: int) -> list[int]:
    """The shards in the order of an epoch, which is that of ``cuts.dealt``."""
    return sorted(shards, key=lambda s: hashlib.md5(f"{seed + epoch}:{s}".encode()).hexdigest())


@dataclass
class Dealt(InputPartition):
    epoch: int
    worker: int
    shards: list[int]


class EpochReader(DataSourceStreamReader):
    """Offsets are an epoch and how many of its shards went before. What was planned last is kept in a file, since latestOffset isn't told it."""

    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        number = lambda k, least: int(options.get(k, least))
        self.path, self.progress, self.names = options["path"], options["progress"], schema.names
        self.seed, self.epochs, self.lot, self.readers = number("seed", 0), number("epochs", 1), max(1, number("shards_per_batch", 1)), max(1, number("world", 1)) * max(1, number("workers", 1))
        fs, root = files_at(self.path)
        most = number("batches_per_epoch", 0)
        self.shards = sorted(int(m[1]) for i in fs.get_file_info(pafs.FileSelector(root)) if (m := FOLDER.fullmatch(i.base_name)))
        self.lot = max(self.lot, -(-len(self.shards) // most)) if most else self.lot

    def initialOffset(self) -> dict:  # noqa: N802
        return {"epoch": 0, "shard": 0}

    def planned(self) -> dict:
        fs, at = files_at(f"{self.progress}/planned.json")
        if fs.get_file_info(at).type != pafs.FileType.File:
            return self.initialOffset()
        with fs.open_input_stream(at) as f:
            return json.loads(f.read())

    def latestOffset(self) -> dict:  # noqa: N802
        at = self.planned()
        if not self.shards or at["epoch"] >= self.epochs:
            return at
        there = min(at["shard"] + self.lot, len(self.shards))  # a batch doesn't span epochs
        return {"epoch": at["epoch"] + 1, "shard": 0} if there == len(self.shards) else {"epoch": at["epoch"], "shard": there}

    def partitions(self, start: dict, end: dict) -> list[Dealt]:
        out = []
        for epoch in range(start["epoch"], end["epoch"] + 1):
            order = dealt_order(self.shards, self.seed, epoch)
            low, high = start["shard"] if epoch == start["epoch"] else 0, end["shard"] if epoch == end["epoch"] else len(order)
            for worker in range(self.readers):
                own = [order[k] for k in range(low, high) if k % self.readers == worker]
                out += [Dealt(epoch, worker, own[i : i + TOGETHER]) for i in range(0, len(own), TOGETHER)]
        fs, folder = files_at(self.progress)
        fs.create_dir(folder, recursive=True)
        part = f"{folder}/planned-{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(json.dumps(end).encode())
        fs.move(part, f"{folder}/planned.json")
        return out

    def read(self, partition: Dealt) -> Iterator[pa.RecordBatch]:
        for shard in partition.shards:
            fs, root = files_at(f"{self.path}/shard_id={shard}")
            own = {"epoch": partition.epoch, "worker": partition.worker, "shard_id": shard}
            for batch in pads.dataset(root, filesystem=fs, format="parquet").to_batches(columns=[c for c in self.names if c not in own]):
                columns = [pa.array([own[c]] * batch.num_rows, pa.int64()) if c in own else batch.column(c) for c in self.names]
                yield pa.record_batch(columns, names=self.names)

    def commit(self, end: dict) -> None:
        """Nothing is kept for batches that are done."""


class Epochs(DataSource):
    """Options: path (as ``writers.shards`` writes it), progress (a folder of the stream's own), seed, epochs, shards_per_batch, batches_per_epoch, world, workers."""

    @classmethod
    def name(cls) -> str:
        return "epochs"

    def streamReader(self, schema: T.StructType) -> EpochReader:  # noqa: N802
        return EpochReader(self.options, schema)


def epochs(spark: SparkSession, path: str, progress: str, seed: int, n: int, shards_per_batch: int = 8, world: int = 1, workers: int = 1, batches_per_epoch: int = 0) -> DataFrame:
    """epoch, worker, shard_id and the shards' columns, as a stream of n epochs over written shards.

    In each epoch every shard comes once, in an order of its own, dealt to the workers of all ranks in turn; a task reads up
    to 32 shards of one worker. With batches_per_epoch an epoch of many shards takes about so many batches, each of more than shards_per_batch shards (0: no bound). A query that is started again with its checkpoint and the same progress folder goes on where it was.
    """
    spark.dataSource.register(Epochs)
    kept = [f for f in spark.read.parquet(path).schema if f.name not in ("epoch", "worker", "shard_id")]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("epoch", "worker", "shard_id")] + kept)
    options = {"path": path, "progress": progress, "seed": seed, "epochs": n, "shards_per_batch": shards_per_batch, "batches_per_epoch": batches_per_epoch, "world": world, "workers": workers}
    return spark.readStream.format("epochs").schema(schema).options(**options).load()


def run_epochs(stream: DataFrame, folder: str, stop_after: int | None = None) -> DataFrame:
    """Runs the stream to its end, or through about so many batches, and returns all rows written; batches are written by number, so one that runs again replaces itself."""
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
        if stop_after is not None and number + 1 >= stop_after:
            raise StopIteration

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        query.processAllAvailable()
    except Exception as e:
        if "StopIteration" not in str(e):
            raise
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows").select(stream.columns)

"""Packing documents into fixed windows by minimum bin slack.

A document's full windows stand for themselves; what remains of each document is
shorter than a window. Only the histogram of the remaining lengths, at most one
entry a length, goes to the driver. There, for the longest length that is left,
a bitset subset-sum over the other lengths with their counts finds the multiset that
fills a window closest to capacity, and backtracking gives its counts; it is then
used as often as the counts allow. Multisets that leave slack are laid end to end
and cut at window bounds, and the last, partial window is cut into powers of two,
which need no padding. Documents find their place by their rank among those of the
same length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import saved
from sluice.llm.tokens import END_ID, KEEP, encoded

CAPACITY = 2048
BROADCAST_ROWS = 100_000


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length, of those that counts offers, come closest to filling room."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= take * length
    return dict(used)


class Plan:
    """Where the items of each length go: runs of ranks, each with what it takes to place a rank."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        left, seen, lots = dict(counts), Counter(), []
        self.capacity, self.windows = capacity, 0
        runs: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)  # first rank, items a window, first window (-1: laid end to end), offset, position
        order = sorted(left, reverse=True)
        for anchor in order:
            while left[anchor]:
                left[anchor] -= 1
                used = Counter(fullest(left, capacity - anchor))
                left[anchor] += 1
                used[anchor] += 1
                times, at = min(left[x] // k for x, k in used.items()), 0
                whole = sum(x * k for x, k in used.items()) == capacity
                for x, k in used.items():
                    if whole:
                        runs[x].append((seen[x], k, self.windows, at, 0))
                        at += x * k
                    else:
                        lots.append((x, seen[x], times * k))
                    seen[x] += times * k
                    left[x] -= times * k
                self.windows += times * whole
        self.laid = self.cut_items = 0
        for x, first, n in lots:
            runs[x].append((first, 1, -1, 0, self.laid))
            self.laid += x * n
        self.tail = self.laid % capacity
        bounds, at = [], self.laid - self.tail
        for bit in reversed(range(capacity.bit_length())):
            if self.tail >> bit & 1:
                bounds.append(at)
                at += 1 << bit
        self.bounds = np.array(bounds, np.int64)
        self.sequences = self.windows + self.laid // capacity + len(bounds)
        self.runs = {x: np.array(sorted(r), np.int64) for x, r in runs.items()}
        self.cut_items = self.laid // capacity + len(bounds)  # one item crosses a bound at most

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the item, length, sequence, offset) of each piece of the item."""
        runs = self.runs[length]
        first, k, window, offset, position = runs[np.searchsorted(runs[:, 0], rank, "right") - 1].tolist()
        if window >= 0:
            return [(0, length, window + (rank - first) // k, offset + (rank - first) % k * length)]
        pieces, at, start = [], position + (rank - first) * length, 0
        while start < length:
            if at < self.laid - self.tail:
                low, seq = at - at % self.capacity, self.windows + at // self.capacity
                high = low + self.capacity
            else:
                i = int(np.searchsorted(self.bounds, at, "right")) - 1
                low, seq = int(self.bounds[i]), self.windows + self.laid // self.capacity + i
                high = int(self.bounds[i + 1]) if i + 1 < len(self.bounds) else self.laid
            n = min(length - start, high - at)
            pieces.append((start, n, seq, at - low))
            start, at = start + n, at + n
        return pieces


def measured(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int, end_id: int | None, keep: int = KEEP) -> DataFrame:
    """A row for each document: id, key (of its text), n (ids), crcs of its full windows, the length and the crc of what remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, crcs, rest = [], [], []
            for data in encoded(batch.column(2), tokenizer, end_id, keep):
                full = len(data) // (4 * capacity) * 4 * capacity
                n.append(len(data) // 4)
                crcs.append([zlib.crc32(data[i : i + 4 * capacity]) for i in range(0, full, 4 * capacity)])
                rest.append(zlib.crc32(data[full:]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rest, pa.int64())], names=["id", "key", "n", "crcs", "rest_crc"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, key long, n long, crcs array<long>, rest_crc long")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int | None = END_ID, keep: int = KEEP) -> DataFrame:
    """A row for each piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in one piece; sequences are full but for at most
    log2(capacity) ones, each of whose lengths is a power of two. Null texts are empty
    documents, which hold end_id alone; a document without ids has no piece. Rows that
    repeat are documents of their own. An empty table gives no rows. keep: words that the
    encoder keeps in each Python worker.
    """
    spark = docs.sparkSession
    rows = saved(measured(docs, tokenizer, id_col, text_col, capacity, end_id, keep).withColumn("uid", F.monotonically_increasing_id()), "measured")
    deals = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // 1_000_000)
    rows = rows.withColumns({"deal": F.pmod(F.xxhash64("uid"), F.lit(deals)), "rest": F.col("n") % capacity})
    counts = saved(rows.groupBy("deal", "rest").agg(F.count("*").alias("n"), F.sum(F.size("crcs")).alias("full")), "lengths")
    plan = Plan({r.rest: r.n for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}, capacity)  # at most one row a length
    known = spark.sparkContext.broadcast(plan)

    before = (Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("deal").rowsBetween(*before)), F.lit(0))).drop("n", "full")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("deal", "rest").orderBy("uid")) - 1).where("rest > 0").join(bases, ["deal", "rest"])
    ranked = ranked.select("id", "key", "n", "rest", "rest_crc", (F.col("rank") + F.col("base")).alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["start", "length", "sequence_id", "offset"]
        for batch in batches:
            row, out = [], []
            for i, (length, rank) in enumerate(zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                pieces = known.value.place(length, rank)
                row += [i] * len(pieces)
                out += pieces
            if not out:
                continue
            cols = np.array(out, np.int64).T
            took = batch.take(pa.array(row, pa.int64()))
            n, rest = (took.column(i).to_numpy() for i in (2, 3))
            crc = pa.array(took.column(4).to_numpy(), mask=cols[1] != rest)
            yield pa.record_batch([took.column(0), took.column(1), took.column(2), crc, pa.array(cols[0] + n - rest), *map(pa.array, cols[1:])], names=["id", "key", "n", "crc", *names])

    kind = rows.schema["id"].dataType.simpleString()
    rest = ranked.mapInArrow(placed, f"id {kind}, key long, n long, crc long, start long, length long, sequence_id long, offset long")
    deal = counts.groupBy("deal").agg(F.sum("full").alias("full")).withColumn("base", F.coalesce(F.sum("full").over(Window.orderBy("deal").rowsBetween(*before)), F.lit(0)))  # one row a deal
    inner = Window.partitionBy("deal").orderBy("uid").rowsBetween(*before)
    full = rows.where(F.size("crcs") > 0).withColumn("ahead", F.coalesce(F.sum(F.size("crcs")).over(inner), F.lit(0))).join(deal.select("deal", "base"), "deal")
    full = full.select("id", "key", "n", (F.col("base") + F.col("ahead") + plan.sequences).alias("first"), F.posexplode("crcs").alias("i", "crc"))
    full = full.select("id", "key", "n", "crc", (F.col("i") * capacity).cast("long").alias("start"), F.lit(capacity).cast("long").alias("length"), (F.col("first") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pieces = saved(rest.unionByName(full), "pieces")

    if plan.cut_items:
        pieces = pieces.where("crc is not null").unionByName(cut_crcs(pieces.where("crc is null").drop("crc"), docs, tokenizer, id_col, text_col, end_id, keep, plan.cut_items <= BROADCAST_ROWS))
    return pieces.select(F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id", "offset")


def cut_crcs(pieces: DataFrame, docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int | None, keep: int, few: bool) -> DataFrame:
    """The pieces of documents that were cut, with crc; just these documents are encoded again. few: they may be broadcast."""
    wanted = pieces.groupBy("id", "key").agg(F.collect_set(F.struct("start", "length")).alias("cuts"))
    texts = docs.select(F.col(id_col).alias("id2"), F.xxhash64(text_col).alias("key2"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    found = texts.join(F.broadcast(wanted) if few else wanted, F.col("id").eqNullSafe(F.col("id2")) & (F.col("key") == F.col("key2")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], []
            for i, (data, cuts) in enumerate(zip(encoded(batch.column(3), tokenizer, end_id, keep), batch.column(2).to_pylist(), strict=True)):
                row += [i] * len(cuts)
                out += [(c["start"], c["length"], zlib.crc32(data[4 * c["start"] : 4 * (c["start"] + c["length"])])) for c in cuts]
            took = batch.take(pa.array(row, pa.int64()))
            yield pa.record_batch([took.column(0), took.column(1), *map(pa.array, np.array(out, np.int64).reshape(-1, 3).T.copy())], names=["id", "key", "start", "length", "crc"])

    kind = docs.schema[id_col].dataType.simpleString()
    crcs = found.select("id", "key", "cuts", "text").mapInArrow(run, f"id {kind}, key long, start long, length long, crc long").distinct().withColumnsRenamed({"id": "id2", "key": "key2", "start": "start2", "length": "length2"})
    same = F.col("id").eqNullSafe(F.col("id2")) & (F.col("key") == F.col("key2")) & (F.col("start") == F.col("start2")) & (F.col("length") == F.col("length2"))
    return pieces.join(crcs, same).drop("id2", "key2", "start2", "length2")

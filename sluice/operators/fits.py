"""Rules that carry a sum from row to row, over channels of any size: what still fits below a cap, and lots that close at a target.

Both work on blocks of a channel's rows, so that a large channel is many tasks' work; in a block the rule
runs on whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.ordering import AHEAD, hash_bucket
from sluice.shared import discard, saved

#: Rows of a channel that one task takes at a time.
BLOCK = 1 << 16
#: Rows that are searched together for the next that fits.
CHUNK = 1 << 11


def taken(lengths: np.ndarray, room: int) -> tuple[np.ndarray, int]:
    """Which of the lengths, in order, still fit into the room when each that fits takes its part, and the room left.

    From where nothing was skipped yet, all fit up to the first sum above the room. What is skipped there, and
    all else that is longer than the room left, never fits again. A chunk whose least length is above the room is
    passed over, and the search ends where no later chunk has a shorter one.
    """
    fits = np.zeros(len(lengths), bool)
    starts = np.arange(0, len(lengths), CHUNK)
    least = np.minimum.reduceat(lengths, starts) if len(lengths) else np.empty(0, lengths.dtype)
    after = np.minimum.accumulate(least[::-1])[::-1]  # the least from here on
    for chunk, low in enumerate(starts.tolist()):
        if after[chunk] > room:
            break
        if least[chunk] > room:
            continue
        at = low + np.flatnonzero(lengths[low : low + CHUNK] <= room)
        while len(at):
            sums = np.cumsum(lengths[at])
            n = int(np.searchsorted(sums, room, "right"))
            fits[at[:n]] = True
            room -= int(sums[n - 1]) if n else 0
            at = at[n + 1 :]
            at = at[lengths[at] <= room]
    return fits, room


def skip_fit(rows: DataFrame, channel: str, key: str, length: str, order: str, cap: int, block: int = BLOCK) -> DataFrame:
    """channel, key and length of the rows that fit: by order (a hexadecimal hash, ties by key) each row that its channel's cap still has room for; what doesn't fit is skipped and the scan goes on.

    Lengths are whole numbers of 0 or more; rows without one never fit. Round by round, a task takes the first rows
    of a channel, about ``block`` of them, and the later rows stay only where they are no longer than the room then left. Nearly always
    a round leaves next to nothing. A bucket of the hash is never parted: that takes channels of over 65,536 * block rows.
    """
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (channel, key, length))
    rows = rows.select(channel, key, length, F.col(order).alias("__order"), hash_bucket(F.col(order)).alias("__bucket"), F.lit(cap).cast("long").alias("__room")).where(F.col(length) <= cap)
    rows, out = saved(rows, "fitting"), None

    def run(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, [("__order", "ascending"), (key, "ascending")]))
        fits, room = taken(group[length].to_numpy().astype(np.int64), group["__room"][0].as_py())
        some = group.filter(pa.array(fits)).select([channel, key, length])
        last = pa.table([group[channel].slice(0, 1), pa.nulls(1, group.schema.field(key).type), pa.nulls(1, group.schema.field(length).type)], names=[channel, key, length])
        both = pa.concat_tables([some, last])  # the row without a key has the room left
        return both.append_column("room", pa.array([None] * some.num_rows + [room], pa.int64()))

    while True:
        counts = rows.groupBy(channel, "__bucket").agg(F.count("*").alias("n"))
        ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(Window.partitionBy(channel).orderBy("__bucket").rowsBetween(*AHEAD)), F.lit(0)))
        upto = ahead.where((F.col("ahead") == 0) | (F.col("ahead") + F.col("n") <= block)).groupBy(channel).agg(F.max("__bucket").alias("__upto"))
        marked = rows.join(upto.withColumnRenamed(channel, "__c"), F.col(channel).eqNullSafe(F.col("__c"))).drop("__c")
        done = saved(marked.where("__bucket <= __upto").groupBy(channel).applyInArrow(run, f"{kinds}, room long"), "fitted")
        fits = done.where("room is null").select(channel, key, length)
        out = fits if out is None else out.unionByName(fits)
        left = done.where("room is not null").select(F.col(channel).alias("__c"), F.col("room"))
        later = marked.where("__bucket > __upto").join(left, F.col(channel).eqNullSafe(F.col("__c"))).where(F.col(length) <= F.col("room"))
        rest = saved(later.select(channel, key, length, "__order", "__bucket", F.col("room").alias("__room")), "fitting")
        discard(rows)
        rows = rest
        if rows.isEmpty():
            discard(rows)
            return out


def next_start(lengths: np.ndarray, ends: np.ndarray, target: int) -> np.ndarray:
    """For each row, where the next lot starts if one starts at it: behind the row that brings the sum to the target, or at the end of its channel."""
    sums = np.cumsum(lengths)
    closing = np.searchsorted(sums, sums - lengths + target, "left")
    return np.minimum(np.maximum(closing, np.arange(len(lengths))) + 1, ends)


def reached(first: np.ndarray, jump: np.ndarray) -> np.ndarray:
    """Marks of all rows to which jumps lead from the first ones, by pointer doubling; a jump beyond the rows ends."""
    n = len(jump)
    marks, jump = np.zeros(n + 1, bool), np.append(jump, n)
    marks[first] = True
    steps = 1
    while steps <= n:
        marks[jump[np.flatnonzero(marks)]] = True
        jump = jump[jump]
        steps *= 2
    return marks[:n]


def last_start(jump: np.ndarray) -> np.ndarray:
    """For each row, the last one to which jumps from it lead, by pointer doubling."""
    at = np.where(jump < len(jump), jump, np.arange(len(jump)))
    while not np.array_equal(further := at[at], at):
        at = further
    return at


#: What a block tells of its first and last channel: arriving with a sum of low to high, it goes on with total, in a lot that begins at start.
PIECES = {"low": "long", "high": "long", "total": "long", "start": "long", "begun": "boolean", "through": "boolean"}


def pieces(lengths: np.ndarray, orders: np.ndarray, target: int) -> list[tuple]:
    """PIECES of one channel's rows in a block. begun: a lot is open at the end; through: the lot that arrives stays open throughout."""
    n, total = len(lengths), np.cumsum(lengths)
    at = last_start(next_start(lengths, np.full(n, n), target))
    out, last = [], int(np.searchsorted(total, target, "left"))  # the row that closes a lot that arrives with nothing
    for j in range(min(last, n - 1) + 1):
        low, high = max(0, target - int(total[j])), target - (int(total[j - 1]) if j else 0) - 1
        if low > high:
            continue
        start = int(at[j + 1]) if j + 1 < n else n
        rest = int(total[-1] - total[start - 1]) if start < n else target
        out.append((low, high, rest, int(orders[start]), True, False) if rest < target else (low, high, 0, None, False, False))
    if last >= n:
        out.append((0, target - int(total[-1]) - 1, int(total[-1]), int(orders[0]), True, True))
    return out


def lots(rows: DataFrame, channel: str, order: str, length: str, target: int, name: str = "lot", block: int = 1 << 20) -> DataFrame:
    """rows with the order value of the first row of their lot: a channel's rows, in order, make a lot until its sum reaches the target, then the next.

    order: a whole number, told apart within a channel. Lengths are whole numbers of 0 or more. Rows are dealt to ranges
    of channel and order, of about ``block`` rows, so a large channel is several tasks' work. Each range tells, for every sum with which
    its first channel may arrive, with which its last goes on; these few rows meet in a task per channel, and give the sum that does arrive.
    """
    if target <= 0:
        return rows.withColumn(name, F.col(order).cast("long"))
    fields = rows.schema.fields
    own = [f.name for f in fields]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // block))

    def spans(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths, orders and where channels start, in a table in order."""
        lengths, orders = (table[c].to_numpy().astype(np.int64) for c in (length, order))
        ids = pa.chunked_array(table[channel].chunks).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        return lengths, orders, np.flatnonzero(np.diff(ids, prepend=-1))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows, then what the block tells of its first and last channel."""
        number, seen = TaskContext.get().partitionId(), []
        told_of = [pa.int64()] * 4 + [pa.bool_()] * 2
        for batch in batches:
            seen.append(batch.select([channel, order, length]))
            yield pa.record_batch([*batch.columns, pa.array([number] * batch.num_rows, pa.int64()), *(pa.nulls(batch.num_rows, t) for t in told_of)], names=[*own, "__block", *PIECES])
        table = pa.Table.from_batches(seen) if seen else None
        if table is not None and table.num_rows:
            lengths, orders, starts = spans(table)
            ends = [*starts[1:].tolist(), len(lengths)]
            for c in {0, len(starts) - 1}:
                here = slice(int(starts[c]), ends[c])
                columns = list(zip(*pieces(lengths[here], orders[here], target), strict=True))
                n = len(columns[0])
                of = table[channel].combine_chunks().take(pa.array([here.start] * n))
                rest = [of if f == channel else pa.nulls(n, seen[0].schema.field(f).type if f in (order, length) else batch.schema.field(f).type) for f in own]
                yield pa.record_batch([*rest, pa.array([number] * n, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, told_of, strict=True))], names=[*own, "__block", *PIECES])

    dealt = rows.repartitionByRange(parts, channel, order).sortWithinPartitions(channel, order)
    dealt = saved(dealt.mapInArrow(tell, f"{kinds}, __block long, " + ", ".join(f"{k} {v}" for k, v in PIECES.items())), "lots")
    channel_kind = rows.schema[channel].dataType.simpleString()

    def chained(group: pa.Table) -> pa.Table:
        """The sum and the lot with which the channel arrives at each of its blocks."""
        by_block: dict[int, list[dict]] = {}
        for row in group.select(["__block", *PIECES]).to_pylist():
            by_block.setdefault(row["__block"], []).append(row)
        carry, lot, out = 0, None, []
        for number in sorted(by_block):
            out.append((number, carry, lot))
            piece = next(r for r in by_block[number] if r["low"] <= carry <= r["high"])
            if piece["through"]:
                carry, lot = carry + piece["total"], piece["start"] if lot is None else lot
            else:
                carry, lot = piece["total"], piece["start"]
        of = group[channel].combine_chunks().take(pa.array([0] * len(out)))
        return pa.table([of, *(pa.array(c, pa.int64()) for c in zip(*out, strict=True))], names=["__c", "__b", "__carry", "__lot"])

    told = dealt.where("low is not null").select(channel, "__block", *PIECES)
    arriving = told.groupBy(channel).applyInArrow(chained, f"__c {channel_kind}, __b long, __carry long, __lot long").where("__lot is not null")

    def finish(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [(channel, "ascending"), (order, "ascending")], null_placement="at_start"))
        lengths, orders, starts = spans(table)
        ends = np.append(starts[1:], len(lengths))
        jump = next_start(lengths, np.repeat(ends, np.diff(np.append(starts, len(lengths)))), target)
        carry, lot = table["__carry"][0].as_py(), table["__lot"][0].as_py()
        if lot is not None:  # the first lot began in an earlier block
            behind = min(int(np.searchsorted(np.cumsum(lengths), target - carry, "left")) + 1, int(ends[0]))
            starts = np.append(starts[1:], behind)
        marks = reached(starts[starts < len(lengths)], jump)
        values = np.append(orders[np.flatnonzero(marks)], 0 if lot is None else lot)[np.cumsum(marks) - 1]
        return table.select(own).append_column(name, pa.array(values, pa.int64()))

    on = (F.col("__block") == F.col("__b")) & F.col(channel).eqNullSafe(F.col("__c"))
    joined = dealt.where("low is null").drop(*PIECES).join(F.broadcast(arriving), on, "left").drop("__b", "__c")  # at most a row a block
    return joined.groupBy("__block").applyInArrow(finish, f"{kinds}, {name} long")

"""Global ranks and running sums without gathering all rows in one task, and folds over sorted groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.shared import saved

AHEAD = (Window.unboundedPreceding, -1)


def seeded(key: Column, seed: int) -> Column:
    """A seeded random order as text: MD5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def ranked(df: DataFrame, order: list[Column], bucket: Column, name: str = "rank") -> DataFrame:
    """df with name: 0 for its first row in order, and so on.

    bucket must not descend as the order ascends. Buckets are numbered apart; only their
    counts, one row a bucket, meet in one task.
    """
    df = df.withColumn("__bucket", bucket)
    ahead = df.groupBy("__bucket").agg(F.count("*").alias("__n")).withColumn("__ahead", F.coalesce(F.sum("__n").over(Window.orderBy("__bucket").rowsBetween(*AHEAD)), F.lit(0))).drop("__n")
    own = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order)) - 1
    return df.withColumn(name, own).join(ahead, "__bucket").withColumn(name, (F.col(name) + F.col("__ahead")).cast("long")).drop("__bucket", "__ahead")


def placed(df: DataFrame, order: list[Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """df with name: 0 for its first row in order, and so on; for orders of any kind, however their values lie.

    Rows are dealt to ranges of sampled bounds and sorted there; only the ranges' counts meet in one task. The
    dealt rows are written, as ranges sampled anew might differ. order should tell rows apart, so that ranges are even.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_range = F.monotonically_increasing_id()  # the range's number above 33 bits of the row's place in it
    dealt = saved(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", in_range), "placed")
    range_of = F.shiftright("__at", 33)
    counts = dealt.groupBy(range_of.alias("__range")).agg(F.count("*").alias("__n"))
    ahead = counts.withColumn("__ahead", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(*AHEAD)), F.lit(0))).drop("__n")
    joined = dealt.withColumn("__range", range_of).join(F.broadcast(ahead), "__range")  # a row a range
    return joined.withColumn(name, (F.col("__ahead") + F.col("__at").bitwiseAND((1 << 33) - 1)).cast("long")).drop("__range", "__at", "__ahead")


def hash_bucket(hashed: Column, digits: int = 4) -> Column:
    """A bucket for rows in the order of a hexadecimal hash."""
    return F.substring(hashed, 1, digits)


def sum_ahead(df: DataFrame, value: str, hashed: str, by: list[str] | None = None, name: str = "ahead") -> DataFrame:
    """df with the sum of value over the rows before in the order of a hexadecimal hash, within by."""
    by, df = by or [], df.withColumn("__bucket", hash_bucket(F.col(hashed)))
    sums = df.groupBy(*by, "__bucket").agg(F.sum(value).alias("__n"))
    sums = sums.withColumn("__ahead", F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__bucket").rowsBetween(*AHEAD)), F.lit(0))).drop("__n")
    own = F.coalesce(F.sum(value).over(Window.partitionBy(*by, "__bucket").orderBy(hashed).rowsBetween(*AHEAD)), F.lit(0))
    return df.withColumn(name, own).join(sums, [*by, "__bucket"]).withColumn(name, F.col(name) + F.col("__ahead")).drop("__bucket", "__ahead")


def folded(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, kind: str, start: Callable[[], object], step: Callable[[object, int], tuple[object, int]]) -> DataFrame:
    """df with out (of kind int or long) = what step gives for each row of a group in order, with the state that it carries on.

    Groups stream through sorted partitions, so a group of any size takes the memory of a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            got = []
            for *key, v in zip(*(batch.column(c).to_pylist() for c in (*keys, value)), strict=True):
                if key != last:
                    last, state = key, start()
                state, result = step(state, v)
                got.append(result)
            yield pa.record_batch([*batch.columns, pa.array(got, {"int": pa.int32(), "long": pa.int64()}[kind])], names=[*batch.schema.names, out])

    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return dealt.mapInArrow(run, f"{kinds}, {out} {kind}")

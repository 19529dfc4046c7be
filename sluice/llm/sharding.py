"""Extendible hashing: documents to shards of a byte limit, in DataFrame operations only.

A directory is indexed by the first bits of a hash of the id. All documents begin in
one bucket; a bucket whose documents exceed the limit splits on the next bit, others
stay as they are. So a shard is a hash prefix, as long as it had to become. Bytes are
summed by a prefix of more bits than most shards need, and the sums of shorter
prefixes come from those; only cells that are too large even so look at more bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import saved

HASH_BITS, LIMIT, SPARE_BITS = 60, 16 << 20, 4


def hashed(key: Column) -> Column:
    """The first 60 bits of the key's MD5; a null key counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(h: str, bits: int) -> Column:
    """The first so many of the hash's bits, as a number."""
    return F.shiftright(h, HASH_BITS - bits)


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """cell, cell_bits, depth: documents (h, size) whose first cell_bits of the hash are cell lie in the shard of their first depth bits.

    depth is as small as the limit lets it; at HASH_BITS nothing is left to split on.
    Each round looks at more bits of what the round before left too large.
    """
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits, at, found, left = 0, min(HASH_BITS, max(1, -(-total // limit)).bit_length() + SPARE_BITS), None, rows
    while True:
        cells = saved(left.groupBy(prefix("h", at).alias("cell")).agg(F.sum("size").alias("size")), "cells")
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(bits), F.lit(at)))).withColumn("part", F.call_function("shiftright", "cell", (F.lit(at) - F.col("depth")).cast("int")))
        fits = levels.groupBy("depth", "part").agg(F.sum("size").alias("bytes")).where((F.col("bytes") <= limit) | (F.col("depth") == HASH_BITS))
        least = levels.join(fits, ["depth", "part"], "left_semi").groupBy("cell").agg(F.min("depth").alias("depth"))
        done = least.withColumn("cell_bits", F.lit(at)).select("cell", "cell_bits", "depth")
        found = done if found is None else found.unionByName(done)
        over = cells.join(least, "cell", "left_anti").select("cell")
        if at == HASH_BITS or over.isEmpty():
            return found
        left = left.withColumn("cell", prefix("h", at)).join(over, "cell", "left_semi").drop("cell")
        bits, at = at + 1, min(HASH_BITS, at + 8)


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """All rows and columns of docs with shard (its bits; '' for the only one), depth, doc_size, shard_size and oversize.

    The size of a row is the text's UTF-8 bytes (null: 0). A row above the limit fits in no
    shard: it gets one of its own, named by its whole hash and a plus sign, and oversize
    is true. Rows of one id have one hash, so they stay together; if they exceed
    the limit together, oversize is true of their shard as well. An empty table gives no
    rows. Columns of docs that are named like those added give way to them.
    """
    docs = docs.drop("shard", "depth", "doc_size", "shard_size", "oversize")
    marked = docs.withColumns({"__h": hashed(F.col(id_col)), "doc_size": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")})
    rows = docs.select(hashed(F.col(id_col)).alias("h"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("size"))
    found = saved(directory(rows.where(F.col("size") <= limit), limit), "directory")
    bits = lambda h, depth: F.substr(F.lpad(F.bin(h), HASH_BITS, "0"), F.lit(1), depth)
    out = None
    for level in sorted(r[0] for r in found.select("cell_bits").distinct().collect()):  # eight at most
        of = found.where(F.col("cell_bits") == level).select(F.col("cell").alias("__cell"), F.col("depth").cast("int"))
        part = marked.where(F.col("doc_size") <= limit).withColumn("__cell", prefix("__h", level)).join(of, "__cell").drop("__cell")
        out = part if out is None else out.unionByName(part)
    large = marked.where(F.col("doc_size") > limit).withColumn("depth", F.lit(HASH_BITS))
    out = large if out is None else out.unionByName(large)
    shard = F.concat(bits(F.col("__h"), F.col("depth")), F.when(F.col("doc_size") > limit, "+").otherwise(""))
    out = out.withColumn("shard", shard)
    sums = out.groupBy("shard").agg(F.sum("doc_size").alias("shard_size"))
    out = out.join(sums.withColumnRenamed("shard", "__shard"), F.col("shard") == F.col("__shard")).drop("__shard")
    return out.withColumn("oversize", F.col("shard_size") > limit).drop("__h")


def write_shards(rows: DataFrame, path: str) -> None:
    """A folder for each shard; each is written by one task, which its limit bounds."""
    rows.withColumn("shard_name", F.when(F.col("shard") == "", "all").otherwise(F.col("shard"))).repartition("shard_name").write.partitionBy("shard_name").parquet(path)


#: The limit of op3_sharding: small, so that small tables have shards of several depths as well.
QUERY_LIMIT = 512 << 10
#: What op3_sharding returns, over a view documents, by DuckDB.
ORACLE = f"""
with rows as (select doc_id, coalesce(octet_length(encode(text)), 0)::bigint as size, ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h from documents),
levels as (select r.*, d.depth, r.h >> (60 - d.depth)::int as part, sum(r.size) over (partition by d.depth, r.h >> (60 - d.depth)::int) as bytes from rows r, (select unnest(range(0, 61))::int as depth) d where r.size <= {QUERY_LIMIT}),
placed as (select doc_id, size, h, min(depth) as depth from levels where bytes <= {QUERY_LIMIT} or depth = 60 group by doc_id, size, h
  union all select doc_id, size, h, 60 from rows where size > {QUERY_LIMIT}),
named as (select *, lpad(bin(h), 60, '0')[1:depth] || case when size > {QUERY_LIMIT} then '+' else '' end as shard from placed)
select doc_id, size, depth, shard, (sum(size) over (partition by shard))::bigint as shard_size, sum(size) over (partition by shard) > {QUERY_LIMIT} as oversize from named
"""

"""Mixing sources to target weights, in DataFrame operations only.

Sizes are summed by source, targets are shared out by weight under a cap, and a
document comes floor(rate) times plus once more if its hash-seeded coin falls below
its source's threshold; the rate is target by size of its source. The threshold is the
rate's fraction, moved to the coin next to it at which the words taken come nearest
to the target: with the bare fraction, sources of some 50 documents miss by up to a fourth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import WORD, saved

WEIGHTS, SHARE, CAP, SEED = (3, 1, 2), (3, 2), 2, "mix"


COIN_BITS, BUCKET_BITS, BUCKET_ROWS = 52, 10, 100_000
BROADCAST_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """df (written, so that counting is cheap) to be broadcast if it has BROADCAST_ROWS at most, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def coin(*key: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 2^52), fixed by the key: the first 52 bits of its MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(k.cast("string"), F.lit("")) for k in key)))
    return F.conv(F.substring(digest, 1, COIN_BITS // 4), 16, 10).cast("long")


def words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP) -> DataFrame:
    """source, source_size, target from source, source_size; one row a source in and out.

    Sources by code point, null last, weigh the given weights in turn and share out
    share (a fraction) of the sum of all sizes. A target stops at cap times its source's
    size and the excess is shared out again by weight until none is above: each round is one
    aggregate over the sources, which may be many. They are numbered within ranges, of which only
    the counts meet in one task. All sums are of integers, so the targets don't depend on the order of rows.
    """
    over, under = share
    spark = sizes.sparkSession
    by_source = F.col("source").asc_nulls_last()
    ranges = sizes.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), by_source).withColumn("range", F.spark_partition_id())
    ranges = saved(ranges, "mix-ranges")
    ahead = ranges.groupBy("range").agg(F.count("*").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    i = F.row_number().over(Window.partitionBy("range").orderBy(by_source)) - 1 + F.col("ahead")
    w = F.element_at(F.array(*map(F.lit, weights)), (i % len(weights) + 1).cast("int")).cast("long")
    ranked = saved(ranges.join(ahead, "range").select("source", "source_size", w.alias("w"), (F.col("source_size") * cap).alias("most")), "mix-ranked")

    exact = lambda x: F.lit(str(x)).cast("decimal(38,0)")
    whole = lambda c: F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    all_size, rest_w = map(int, ranked.agg(whole(F.col("source_size")), whole(F.col("w"))).first())
    stopped = 0
    while True:
        left = all_size * over - stopped * under  # times under
        stops = F.col("most") * exact(under * rest_w) <= exact(left) * F.col("w") if rest_w else F.lit(True)
        now = tuple(map(int, ranked.agg(whole(F.when(stops, F.col("most"))), whole(F.when(~stops, F.col("w")))).first()))
        if now == (stopped, rest_w):
            break
        stopped, rest_w = now
    most = F.col("most").cast("double")
    shared = (exact(left) * F.col("w")).cast("double") / F.lit(float(max(1, rest_w * under)))
    return ranked.select("source", "source_size", F.when(stops, most).otherwise(shared).alias("target"))


def bucket_bits(rows: int) -> int:
    """So many first bits of the coins that a bucket of one source has some BUCKET_ROWS rows at most."""
    return min(COIN_BITS, max(BUCKET_BITS, (rows // BUCKET_ROWS).bit_length()))


def thresholds(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP, bits: int = BUCKET_BITS) -> DataFrame:
    """source, source_size, target, whole (copies of every row) and below (coins below it bring one more) for rows of source, n, coin.

    Coins fall to buckets by their first bits (so many); sums by source and bucket tell in which
    bucket the words reach what is wanted, and only that bucket's rows are put in order.
    """
    bucket = F.shiftright("coin", COIN_BITS - bits)
    sums = saved(sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("n").alias("n")), "mix-sums")
    goal = targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, cap)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    goal = saved(goal.withColumn("whole", F.floor(rate).cast("long")).withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size")), "mix-goal")

    same = F.col("source").eqNullSafe(F.col("of"))
    of = goal.select(F.col("source").alias("of"), "wanted")
    by_coin = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = sums.withColumn("ahead", F.coalesce(F.sum("n").over(by_coin), F.lit(0))).join(of, same).where((F.col("ahead") <= F.col("wanted")) & (F.col("wanted") < F.col("ahead") + F.col("n"))).select("of", "wanted", "ahead", F.col("bucket").alias("in"))
    edge = saved(edge, "mix-edge")
    rows = sized.join(small(edge), same & (bucket == F.col("in"))).groupBy("of", "wanted", "ahead", "in", "coin").agg(F.sum("n").alias("n"))
    reached = F.col("ahead") + F.sum("n").over(Window.partitionBy("of").orderBy("coin"))
    stops = rows.select("of", (F.col("coin") + 1).alias("below"), F.abs(reached - F.col("wanted")).alias("miss"))
    stops = stops.unionByName(edge.select("of", F.shiftleft("in", COIN_BITS - bits).alias("below"), F.abs(F.col("ahead") - F.col("wanted")).alias("miss")))
    best = stops.groupBy("of").agg(F.min(F.struct("miss", "below"))["below"].alias("below"))
    return goal.join(best, same, "left").select("source", "source_size", "target", "whole", F.when(F.col("wanted") > 0, F.col("below")).otherwise(F.lit(0).cast("long")).alias("below"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """All rows and columns of docs with mix_size (words; null text: 0), source_size, target and copies.

    A null source is a source of its own, after all others. A source without words has
    target 0 and no copies. Rows that share an id share a coin. An empty table gives no rows.
    Columns of docs that are named like those added give way to them.
    """
    docs = docs.drop("mix_size", "source_size", "target", "copies")
    sized = docs.select(F.col(source_col).alias("source"), words(text_col).alias("n"), coin(F.col(id_col), seed=seed).alias("coin"))
    goal = small(saved(thresholds(sized, weights, share, cap, bucket_bits(docs.count())).withColumnRenamed("source", "__source"), "mix-thresholds"))
    out = docs.withColumns({"mix_size": words(text_col), "__coin": coin(F.col(id_col), seed=seed)}).join(goal, F.col(source_col).eqNullSafe(F.col("__source")))
    return out.withColumn("copies", F.col("whole") + (F.col("__coin") < F.col("below")).cast("long")).drop("__source", "__coin", "whole", "below")


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as copies says."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("__copy")


#: The same over a view documents, by DuckDB.
ORACLE = r"""
with sized as (select doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
per_source as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (select *, ([3, 1, 2])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as w from per_source),
capped as (select *, 2 * source_size as most, row_number() over (order by source nulls last) as i from ranked),
summed as (select *, sum(w) over () as all_w, sum(source_size) over () as all_size,
  coalesce(sum(w) over (order by most::double / w, i rows between unbounded preceding and 1 preceding), 0) as ahead_w,
  coalesce(sum(most) over (order by most::double / w, i rows between unbounded preceding and 1 preceding), 0) as ahead_most from capped),
stopping as (select *, most * 2 * (all_w - ahead_w) <= (all_size * 3 - ahead_most * 2) * w as stops from summed),
goal as (select source, source_size, case when stops then most::double else ((all_size * 3 - coalesce(sum(case when stops then most end) over (), 0) * 2) * w)::double
  / (coalesce(sum(case when not stops then w end) over (), 0) * 2)::double end as target from stopping),
rated as (select d.doc_id, d.source, d.size, g.source_size, g.target, case when g.source_size > 0 then floor(g.target / g.source_size::double) else 0 end as whole,
  ('0x' || substr(md5('mix:' || coalesce(d.doc_id::varchar, '')), 1, 13))::bigint as coin
  from sized d join goal g on d.source is not distinct from g.source),
reached as (select source, coin, target - whole * source_size as wanted, sum(size) over (partition by source order by coin) as n from rated),
stops as (select source, coin + 1 as below, abs(n - wanted) as miss from reached union all select distinct source, 0, wanted from reached),
best as (select source, arg_min(below, (miss, below)) as below from stops group by source)
select r.doc_id, r.size, r.source_size, r.target, ((whole + case when coin < below then 1 else 0 end) * r.size)::bigint as taken
from rated r join best b on r.source is not distinct from b.source
"""

"""Train and holdout splits that share no channel, with limits by language and channel."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.fits import skip_fit
from sluice.operators.ordering import seeded, sum_ahead
from sluice.shared import discard, saved


@dataclass(frozen=True)
class Limits:
    """Lengths are whole milliseconds, so that sums don't depend on the order of rows."""

    seed: int = 1337
    shortest: int = 3_000
    longest: int = 900_000
    holdout: int = 3_600_000
    channel: int = 2_160_000
    target: int = 20_000_000
    mix: dict[str, float] = field(default_factory=lambda: {"en": 0.5, "fr": 0.25, "de": 0.25})


def usable(clips: DataFrame, blocked: DataFrame, limits: Limits) -> DataFrame:
    """Clips of a permitted length (both ends included) whose channel isn't blocked."""
    return clips.where(F.col("duration_ms").between(limits.shortest, limits.longest)).join(blocked, "channel_id", "left_anti")


def channel_totals(clips: DataFrame) -> DataFrame:
    """n, total_ms and the first clip's language of each channel."""
    return clips.groupBy("channel_id").agg(F.count("*").alias("n"), F.sum("duration_ms").alias("total_ms"), F.min_by("language", "row_index").alias("language"))


def holdout_channels(channels: DataFrame, limits: Limits) -> DataFrame:
    """Channels in seeded order for as long as those before fall short of the limit; the last one may go beyond it."""
    ordered = channels.withColumn("__order", seeded(F.col("channel_id"), limits.seed))
    return sum_ahead(ordered, "total_ms", "__order").where(F.col("ahead") < limits.holdout).drop("__order")


def fitting(over: DataFrame, limits: Limits) -> DataFrame:
    """channel_id, row_index, duration_ms of the clips of too long channels that still fit, in seeded order: what doesn't fit is skipped, the scan goes on."""
    ordered = over.select("channel_id", "row_index", "duration_ms").withColumn("__order", seeded(F.col("row_index"), limits.seed))
    return skip_fit(ordered, "channel_id", "row_index", "duration_ms", "__order", limits.channel)


def capped(clips: DataFrame, limits: Limits, totals: DataFrame | None = None) -> DataFrame:
    """Clips of channels within the cap; of others those that still fit. totals: channel_id and total_ms of these clips' channels, if known."""
    totals = saved(channel_totals(clips).select("channel_id", "total_ms"), "totals") if totals is None else totals
    over = clips.join(totals.where(F.col("total_ms") > limits.channel).select("channel_id"), "channel_id", "left_semi")
    fits = over.join(fitting(over, limits).select("row_index"), "row_index", "left_semi")
    whole = clips.join(totals.where(F.col("total_ms") <= limits.channel).select("channel_id"), "channel_id", "left_semi")
    return whole.unionByName(fits.select(whole.columns)).select(clips.columns)


def decided(clips: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """Two written tables: channel_id, split and whole of the chosen channels, and row_index of the clips that stay of those which aren't whole.

    Holdout takes whole channels. Train takes, for each language of the mix, the rest's
    channels (of that language by their first clip) in seeded order, capped, for as
    long as those before fall short of the language's share of the target.
    """
    channels = saved(channel_totals(clips), "channels")
    held = saved(holdout_channels(channels, limits).select("channel_id"), "held")
    rest = channels.join(held, "channel_id", "left_anti").withColumn("whole", F.col("total_ms") <= limits.channel)
    fits = saved(fitting(clips.join(rest.where("not whole").select("channel_id"), "channel_id", "left_semi"), limits), "fitting")
    shares = {k: int(limits.target * v) for k, v in limits.mix.items()}
    share = F.coalesce(*(F.when(F.col("language") == k, F.lit(v).cast("long")) for k, v in shares.items()))
    # a channel of which nothing fits has no rows, and takes none of its language's share
    kept = rest.join(fits.groupBy("channel_id").agg(F.sum("duration_ms").alias("fits_ms")), "channel_id", "left").withColumn("kept_ms", F.when(F.col("whole"), F.col("total_ms")).otherwise(F.col("fits_ms")))
    order = saved(kept.where(F.col("kept_ms").isNotNull() & F.col("language").isin(list(shares))).withColumn("__order", seeded(F.col("channel_id"), limits.seed)), "order")
    train = sum_ahead(order, "kept_ms", "__order", ["language"]).where(F.col("ahead") < share).select("channel_id", F.lit("train").alias("split"), "whole")
    both = saved(train.unionByName(held.select("channel_id", F.lit("holdout").alias("split"), F.lit(True).alias("whole"))), "decided")
    discard(channels, held, order)
    return both, fits.select("row_index")


def split(clips: DataFrame, blocked: DataFrame, limits: Limits) -> DataFrame:
    """The chosen clips with split: holdout or train.

    Only tables of a row a channel, and the ids of what fits into too long channels, are
    made on the way; the clips themselves are read once more for the result.
    """
    good = usable(clips, blocked, limits)
    channels, fits = decided(good, limits)
    marked = good.join(channels, "channel_id")
    part = marked.where("not whole").join(fits, "row_index", "left_semi")
    return marked.where("whole").unionByName(part.select(marked.columns)).select(*good.columns, "split")


def overlap(clips: DataFrame) -> DataFrame:
    """overlap: how many channels are on both sides."""
    side = lambda s: clips.where(F.col("split") == s).select("channel_id")
    return side("train").intersect(side("holdout")).agg(F.count("*").alias("overlap"))


def stats(chosen: DataFrame, limits: Limits) -> DataFrame:
    """One row of counts, lengths, distinct channels, the longest clip and the shortfall from the target in percent."""
    train, held = F.col("split") == "train", F.col("split") == "holdout"
    total = lambda side: F.coalesce(F.sum(F.when(side, F.col("duration_ms"))), F.lit(0))
    return chosen.agg(
        total(train).alias("train_ms"), total(held).alias("holdout_ms"), F.count_if(train).alias("train_segments"), F.count_if(held).alias("holdout_segments"),
        F.countDistinct(F.when(train, F.col("channel_id"))).alias("train_channels"), F.countDistinct(F.when(held, F.col("channel_id"))).alias("holdout_channels"),
        F.coalesce(F.max(F.when(train, F.col("duration_ms"))), F.lit(0)).alias("longest_ms"), ((1 - total(train) / F.lit(limits.target)) * 100).alias("shortfall_pct"),
        (total(train) < 0.95 * limits.target).alias("short"),
    )


def hours_by(chosen: DataFrame, column: str) -> DataFrame:
    return chosen.where("split = 'train'").groupBy(column).agg((F.sum("duration_ms") / 3_600_000).alias("hours"))


def top_by_hours(chosen: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n longest groups; ties in the order of their first rows."""
    sums = chosen.where("split = 'train'").groupBy(column).agg(F.sum("duration_ms").alias("total_ms"), F.min("row_index").alias("first_row"))
    return sums.orderBy(F.desc("total_ms"), "first_row").limit(n)


def top_sources(clips: DataFrame, n: int = 10) -> DataFrame:
    """rank, channel_id, total_ms, n and the first non-empty title of the n longest channels; ties by id."""
    sums = clips.groupBy("channel_id").agg(F.sum("duration_ms").alias("total_ms"), F.count("*").alias("n"), F.coalesce(F.min_by("title", F.when(F.col("title") != "", F.col("row_index"))), F.lit("")).alias("title"))
    best = sums.orderBy(F.desc("total_ms"), "channel_id").limit(n)  # n rows
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total_ms"), "channel_id")).cast("long"))

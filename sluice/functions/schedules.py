"""Training schedules and estimates as columns of a step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tri_stage_lr(step: Column, peak: float, warmup: int | Column, hold_ratio: float, updates: int | Column) -> Column:
    """Linear to peak in warmup steps, held for hold_ratio of what is left, then decaying to a hundredth at updates. Both may differ from run to run."""
    warm, last = F.lit(warmup), F.lit(updates)
    hold_end = warm + F.floor(F.lit(hold_ratio) * (last - warm))
    rising = F.lit(peak) * step / F.nullif(warm, F.lit(0))
    falling = F.lit(peak) * F.pow(F.pow(F.lit(0.01), F.lit(1.0) / F.greatest(last - hold_end, F.lit(1))), F.when(last > hold_end, step - hold_end).otherwise(0))
    return F.when(step < warm, rising).when(step < hold_end, F.lit(peak)).otherwise(falling)


def gumbel_temperature(step: Column, top: float, bottom: float, decay: float) -> Column:
    return F.greatest(F.lit(bottom), F.lit(top) * F.pow(F.lit(decay), step))


def accumulation_steps(target_seconds: Column, batch_seconds: Column, world: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(target_seconds / (batch_seconds * world)))


def eta_hours(updates: Column, batch_seconds: Column, seconds_per_second: Column) -> Column:
    """Hours for so many updates of batch_seconds each at a throughput."""
    return updates * batch_seconds / seconds_per_second / 3600

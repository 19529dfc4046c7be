"""Functions on numeric arrays as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(x: Column, epsilon: float = 1e-7) -> Column:
    """Zero mean and unit (population) variance; epsilon under the root keeps constant arrays finite."""

    def let(value: Column, use: Callable[[Column], Column]) -> Column:
        """use of a value that is worked out once, not anew for each element that needs it."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)
    scaled = lambda c: let(F.sqrt(mean(F.transform(c, lambda v: v * v)) + epsilon), lambda d: F.transform(c, lambda v: v / d))
    centred = lambda y: let(mean(y), lambda m: let(F.transform(y, lambda v: v - m), scaled))
    return let(F.transform(x, lambda v: v.cast("double")), centred)


def padded(x: Column, length: Column) -> Column:
    """x with zeros behind it up to length."""
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), (length - F.size(x)).cast("int")))


def mask(x: Column, length: Column) -> Column:
    """Ones for the elements of x, zeros for padding."""
    return F.concat(F.array_repeat(F.lit(1).cast("long"), F.size(x)), F.array_repeat(F.lit(0).cast("long"), (length - F.size(x)).cast("int")))

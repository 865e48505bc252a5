"""Binary search in arrays, as an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_at_most(size: Column, element: Callable[[Column], Column], value: Column,
                  finish: Callable[[Column], Column] = lambda n: n) -> Column:
    """How many elements of a sorted array are at most ``value``; ``element(i)`` is its i-th element (null beyond it).
    ``finish`` turns the count into the result.  A null value has none; a null array gives null."""
    # the count grows by falling powers of two while the element it reaches is at most the value; the state is one number
    digits = F.length(F.bin(size))
    steps = F.slice(F.array(*[F.lit(1 << i) for i in range(30, -1, -1)]), 32 - digits, digits)
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(element(n + step - 1) <= value, n + step).otherwise(n), finish)

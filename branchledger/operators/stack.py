"""Stacking of feeds, and year-over-year alignment without a self join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union-all by name; columns absent from a frame become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_tagged(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    return stack([df.withColumn(tag, F.lit(label)) for label, df in frames.items()])


def aligned_sums(
    parts: Mapping[str, DataFrame], keys: Sequence[str], measure: str
) -> DataFrame:
    """One row per key with one summed column per part (a full outer join by grouping).

    Each part has ``keys`` and ``measure``; a key missing from a part gives null there.
    """
    names = list(parts)
    wide = stack([df.select(*keys, F.col(measure).alias(n)) for n, df in parts.items()])
    return wide.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def growth(now: Column, before: Column) -> Column:
    """Relative change; null without a base or on a zero base."""
    return F.try_divide(now - before, F.nullif(before, F.lit(0).cast("decimal(18,2)")))

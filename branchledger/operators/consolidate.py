"""Entity consolidation: several source platforms -> one row per business code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from branchledger.functions.text import norm_code


class Platform(NamedTuple):
    """One source: its frame, the code column and the columns it contributes."""

    df: DataFrame
    code: str
    columns: Sequence[str]


def consolidate(platforms: Mapping[str, Platform], code: str) -> DataFrame:
    """One row per code with ``<platform>__<column>`` values and a ``platforms`` list.

    Every value is the column-wise maximum within its platform. All platforms are tagged,
    stacked and reduced by one grouping (one shuffle with map-side combine) instead of a
    spine, a grouping and a join per platform. Rows without a code are dropped: they can
    match nothing.
    """
    tagged = [
        p.df.select(
            norm_code(F.col(p.code)).alias(code),
            F.lit(True).alias(f"{name}__seen"),
            *[F.col(c).alias(f"{name}__{c}") for c in p.columns],
        )
        for name, p in platforms.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    values = [c for c in stacked.columns if c != code]
    merged = (
        stacked.filter(F.col(code).isNotNull())
        .groupBy(code)
        .agg(*[F.max(c).alias(c) for c in values])
    )
    seen = [F.when(F.col(f"{name}__seen"), F.lit(name)) for name in sorted(platforms)]
    return merged.withColumn("platforms", F.concat_ws(", ", *seen))


def from_sources(column: str, *order: str) -> list[Column]:
    """``column`` as held by each platform, in priority order."""
    return [F.col(f"{name}__{column}") for name in order]

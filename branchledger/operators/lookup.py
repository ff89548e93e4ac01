"""Lookups that add columns and never add rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from branchledger.operators.skew import skewed_lookup_join


def unique_lookup(lookup: DataFrame, keys: Sequence[str], take: Sequence[str]) -> DataFrame:
    """One row per key: of duplicate keys the smallest ``take`` tuple is kept.

    ``min`` combines map-side, so a key that holds most rows is reduced before the
    shuffle. A null key forms a group that matches nothing.
    """
    picked = lookup.groupBy(*keys).agg(F.min(F.struct(*take)).alias("picked"))
    return picked.select(*keys, *[F.col("picked")[c].alias(c) for c in take])


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Left join of ``fact`` to a de-duplicated lookup; ``on`` maps fact -> lookup column.

    The optimizer broadcasts the lookup while it is under the session's size threshold.
    Past it the join is a shuffle; ``spread_by`` names fact columns that cut a hot key, if a sketch
    of the fact's keys shows one, into parts. It stays empty for a fact that was already grouped by
    the key.
    """
    right = unique_lookup(lookup, list(on.values()), take)
    right = right.select(*[F.col(r).alias(l) for l, r in on.items()], *take)
    if spread_by:
        return skewed_lookup_join(fact, right, list(on), spread_by)
    return fact.join(right, list(on), "left")


def any_of_names(dim: DataFrame, names: Sequence[str], code: str) -> DataFrame:
    """(match_name, code) with one row per name found in any of several name columns.

    Joining to this on one equality replaces ``a = x OR a = y``, which can only run as a
    nested loop over all pairs.
    """
    exploded = dim.select(F.explode(F.array(*names)).alias("match_name"), F.col(code))
    return unique_lookup(exploded, ["match_name"], [code])


def duplicate_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would multiply fact rows if joined without de-duplication."""
    return (
        lookup.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def drop_codes(df: DataFrame, column: str, codes: Sequence[str]) -> DataFrame:
    """Explicit exclusion list of codes; a null code is kept."""
    excluded: Column = F.col(column).isin(*codes) if codes else F.lit(False)
    return df.filter(F.col(column).isNull() | ~excluded)

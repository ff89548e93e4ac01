"""Keep one row per key under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` tuple per key; remaining columns break ties.

    Written as an aggregate rather than a ranking window: it combines map-side, so a key
    with very many versions is never sorted in one task. Null order values rank lowest.
    """
    columns = df.columns
    rest = [c for c in columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(*keys, *[F.col("newest")[c].alias(c) for c in [*order, *rest]]).select(
        *columns
    )


def replace_groups(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows less the groups that ``updates`` holds, and every row of ``updates``.

    Rows with a null key belong to no group; such a row is replaced by an equal one only, so
    applying the same updates again changes nothing and loses nothing.
    """
    unkeyed = F.array_contains(F.array(*[F.col(k).isNull() for k in keys]), True)
    touched = updates.filter(~unkeyed).select(*keys).distinct()
    loose = updates.filter(unkeyed).select([F.col(c).alias(f"new_{c}") for c in existing.columns])
    same = [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in existing.columns]
    kept = existing.filter(~unkeyed).join(touched, list(keys), "left_anti")
    kept = kept.select(existing.columns).unionByName(
        existing.filter(unkeyed).join(loose.distinct(), same, "left_anti")
    )
    return kept.unionByName(updates.select(existing.columns))


def upsert(
    existing: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Existing rows with updates applied: new keys are added, newer versions win.

    On an equal ``order`` value the updated row wins. Rows with a null key are no versions of
    one another: all pass, and an update replaces only rows equal to it.
    """
    keyed = ~F.array_contains(F.array(*[F.col(k).isNull() for k in keys]), True)
    loose = replace_groups(existing.filter(~keyed), updates.filter(~keyed), keys)
    existing, updates = existing.filter(keyed), updates.filter(keyed)
    stacked = existing.withColumn("is_update", F.lit(0)).unionByName(
        updates.withColumn("is_update", F.lit(1)), allowMissingColumns=True
    )
    newest = latest_per_key(stacked, keys, [*order, "is_update"]).drop("is_update")
    return newest.unionByName(loose, allowMissingColumns=True)

"""Left joins that stay balanced when a few keys hold a large share of the rows.

Adaptive execution splits a hot partition only where both join inputs come straight from a
shuffle. A right side that was just grouped by the join key, or a chain of joins on one
key, does not qualify; these operators split such joins themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from branchledger.functions.local import config_table

#: Rows of one key that a task may get; all of these only shape the plan, never the result.
HOT_ROWS = 2_000_000
NULL_SALTS = 1024
#: Hot keys that are split at most, and keys that the sketch follows to find them.
MOST_HOT, TRACKED = 1000, 10_000
SKETCH_GROUPS = 1024
HOT, SALT, PARTS = "__hot", "__salt", "__parts"


def spread_nulls(key: Column, by: Column) -> Column:
    """Left-join key whose nulls, which match nothing, scatter over all partitions.

    Left as null they would hash to one partition. Real keys never start with U+0001.
    """
    return F.coalesce(key, F.concat(F.lit("\u0001"), F.xxhash64(by).cast("string")))


def copies(n: Column | int) -> Column:
    """Array 0 .. n-1 of salts, to explode a right side into one copy per salt."""
    last = (F.lit(n) if isinstance(n, int) else n) - 1
    return F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))


def within_broadcast(spark: SparkSession, size: int) -> bool:
    """Whether so many bytes are under the session's broadcast threshold."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not limit.startswith("-") and size <= spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer, by its own estimate of ``df``, may broadcast it in this session."""
    return within_broadcast(df.sparkSession, df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def skewed_lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to a lookup: as it is where it is small, else with hot keys cut into parts.

    A lookup that may be broadcast is neither copied nor shuffled. For a larger one a sketch of
    the left keys, one scan of these columns, finds the hot ones; only their lookup rows are copied.
    """
    if fits_broadcast(right):
        return left.join(right, list(keys), "left")
    return salted_left_joins(left, [right], keys, spread_by, heavy_keys(left, keys, hot_rows))


def heavy_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, most: int = MOST_HOT, tracked: int = TRACKED
) -> DataFrame:
    """Keys of about more than ``hot_rows`` rows, with the parts to cut each into, from a sketch.

    A task's sketch has a fixed size; sketches are combined in groups first, so that no task reads
    those of all. Every key that holds more than about 1/``tracked`` of the rows is found, and the
    result is a local table of ``most`` rows at most. It is computed when the plan is built.
    """
    known = df.select(*keys).dropna().select(F.xxhash64(*keys).alias(HOT))
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("group")
    some = known.groupBy(group).agg(F.expr(f"approx_top_k_accumulate({HOT}, {tracked})").alias("sketch"))
    top = some.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    found = top.select(F.expr(f"inline(approx_top_k_estimate(sketch, {most}))"))
    rows = [(r.item, -(-r["count"] // hot_rows)) for r in found.collect() if r["count"] > hot_rows]
    return config_table(df.sparkSession, rows, f"{HOT} long, {PARTS} long")


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_rows); counts combine map-side, so one key never gathers in one task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def hot_keys(counts: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of ``rows_per_key`` above ``hot_rows`` rows, with the parts to cut each into.

    At most total / hot_rows keys qualify.
    """
    parts = F.ceil(F.col("n_rows") / F.lit(hot_rows))
    return counts.filter(F.col("n_rows") > hot_rows).select(F.xxhash64(*keys).alias(HOT), parts.alias(PARTS))


def salted_left_joins(
    left: DataFrame,
    rights: Sequence[DataFrame],
    keys: Sequence[str],
    spread_by: Sequence[str],
    hot: DataFrame,
) -> DataFrame:
    """Chain of left joins on key columns shared by ``left`` and every right side.

    Rows of a hot key are cut into parts of about ``hot_rows`` rows by a hash of
    ``spread_by`` and the matching right rows are copied once per part; all other rows keep
    salt 0 and one copy. Null keys match nothing and are scattered. Every input is shuffled
    once on (keys, salt) and the whole chain reuses that partitioning.

    ``hot`` comes from ``heavy_keys``, which bounds its rows, or from ``hot_keys``; it is
    broadcast where the optimizer knows it to be small enough. Keys are told by a hash; one that
    shares a hot key's hash is cut into parts as well.
    """

    def mark(df: DataFrame) -> DataFrame:
        return df.join(hot, F.xxhash64(*[df[k] for k in keys]) == hot[HOT], "left").drop(HOT)

    row_hash = F.xxhash64(*spread_by)
    # A zero that the optimizer cannot fold: the salt stays a join key even where nothing is hot, so
    # the right side is shuffled afresh and adaptive execution can split what turns out to be.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    any_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    salt = (
        F.when(F.col(PARTS).isNotNull(), F.pmod(row_hash, F.col(PARTS)))
        .when(any_null, F.pmod(row_hash, F.lit(NULL_SALTS)))
        .otherwise(zero)
    )
    out = mark(left).withColumn(SALT, salt.cast("bigint")).drop(PARTS)
    for right in rights:
        parts = F.coalesce(F.col(PARTS), F.lit(1))
        copied = mark(right).withColumn(SALT, F.explode(copies(parts))).withColumn(SALT, F.col(SALT) + zero).drop(PARTS)
        out = out.join(copied, [*keys, SALT], "left")
    return out.drop(SALT)

"""Shared helpers: tables in the shared folder, connected components, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch that goes to Python. Spark's own bound, 64 MB, is held on both sides.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "1m"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, through Spark's own file service.

    Batches get a bound for texts, unless the session has set its own.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_package_sent", None) is None:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(), os.path.basename(package))
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
        context._package_sent = True


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; if unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage for good."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a row filter; its size does not depend on the rows.
FILTER_BITS = 1 << 26


def filter_bit(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))


def row_filter(df: DataFrame, *columns: str) -> np.ndarray:
    """A bit for each hash of the rows' ``columns``: a filter of fixed size for another table.

    Where it is full it lets every row pass, so it must stand before a join, never for one.
    """
    bit = df.select((filter_bit(*columns) + 1).alias("bit"))
    buckets = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in buckets.collect():  # FILTER_BITS bits in all
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def passing(filter_: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (filter_[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 > 0


def let_pass(df: DataFrame, filter_: Broadcast, *columns: str, keep: bool = True) -> DataFrame:
    """The rows of ``df`` whose ``columns`` pass a row filter, or with ``keep=False`` the others."""
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1024):
            passed = passing(filter_.value, batch.column(batch.num_columns - 1).to_numpy())
            yield batch.select(batch.schema.names[:-1]).filter(pa.array(passed == keep))

    return df.select("*", filter_bit(*columns).alias("filter_bit")).mapInArrow(releasing(run), own)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a number's decimal text modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def collided(df: DataFrame, key: str, check: str, most: int = 10_000) -> list[int]:
    """Values of ``key``, a 64-bit hash, that stand for more than one ``check``, another one.

    A corpus of 5 * 10^10 has about 70. More than ``most`` are no chance and fail the job.
    """
    several = df.groupBy(key).agg(F.min(check).alias("least"), F.max(check).alias("most")).where("least <> most")
    found = [r[0] for r in several.select(key).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values of {key} collide")
    return found


def told_apart(key: str, check: str, several: list[int]) -> Column:
    """``key``, but where it stands for several things their ``check``."""
    return F.when(F.col(key).isin(several), F.col(check)).otherwise(F.col(key)) if several else F.col(key)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Strings of an Arrow column as UTF-8 bytes, nulls kept."""
    return column.cast(pa.large_binary()).to_pylist()


def releasing(run: Callable) -> Callable:
    """A batch function that gives its memory back when its task ends: Python workers live on."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return wrapped


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that Python copies of few texts exist at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in batches sorted by them. Holds one run at a time."""
    open_run: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        new[0] = last != tuple(batch.column(k)[0].as_py() for k in keys)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(new)
        if cuts.size == 0:
            open_run.append(batch)
        else:
            if cuts[0] > 0:
                open_run.append(batch.slice(0, cuts[0]))
            if open_run:
                yield pa.Table.from_batches(open_run)
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield pa.Table.from_batches([batch.slice(a, b - a)])
            open_run = [batch.slice(cuts[-1])]
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if open_run:
        yield pa.Table.from_batches(open_run)


def _stars(most: int):
    """Edges to the smallest node of each component of a task's edges, ``most`` nodes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        def batch_out() -> pa.RecordBatch:
            nodes = [x for x, up in root.items() if x != up]
            made = pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["a", "b"])
            root.clear()
            return made

        for batch in sliced(batches, 4096):
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
            if len(root) >= most:
                yield batch_out()
        yield batch_out()

    return run


def components(edges: DataFrame, name: str = "components", most: int = 1 << 17) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: ``node, root``, root the smallest node.

    Tasks first replace their own edges by stars, ``most`` nodes at a time. A graph that is left
    with no more than half of ``most`` edges is one such piece. A larger one goes through
    alternating large-star and small-star rounds: every round replaces the edges by edges to
    smaller neighbours, a number of rounds logarithmic in the longest path. Each round groups
    with map-side minima and joins them back. A node with very many neighbours is one key of that
    join; both of its sides are shuffled for it, so adaptive execution can split the node's rows.
    Nodes without an edge to another node are absent from the result.
    """
    # Always 0, but no constant to the optimizer: the minima's own partitioning does not fit the join.
    def zero(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(1)).alias("zero")

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        # pairs (u, v): the neighbours v of u; larger star hangs only the larger neighbours.
        lowest = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", "m", zero("m"))
        joined = pairs.select("u", "v", zero("v")).join(lowest, ["u", "zero"]).withColumn("m", F.least("u", "m"))
        if larger:
            return joined.where("v > u").selectExpr("v a", "m b").distinct()
        hung = joined.selectExpr("v a", "m b").union(joined.selectExpr("u a", "m b"))
        return hung.where("a <> b").distinct()

    def size(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003)).first())

    def named(stars: DataFrame) -> DataFrame:
        return stars.selectExpr("a node", "b root").union(stars.selectExpr("b node", "b root").distinct())

    edges = written(edges.where("a <> b").select("a", "b").mapInArrow(_stars(most), "a long, b long"), name)
    pieces = -(-edges.count() * 2 // most)
    contracted = edges.coalesce(max(1, pieces)).mapInArrow(_stars(most), "a long, b long")
    if pieces <= 1:
        return named(written(contracted, name))
    edges = written(contracted.distinct(), name)
    now = size(edges)
    while True:
        both = edges.selectExpr("a u", "b v").union(edges.selectExpr("b u", "a v"))
        large = star(both, True)
        small = star(large.selectExpr("a u", "b v"), False)
        last, edges = edges, written(small, name)
        before, now = now, size(edges)
        # Equal sums tell of equal edges almost always; the comparison makes sure.
        if now == before and edges.join(last, ["a", "b"], "left_anti").isEmpty():
            return named(edges)

"""Hard-negative mining with exact integer scores from float32 matrix products.

A score is the integer inner product of two vectors of integers. It is computed in a residue
number system: components modulo several primes, small enough for a float32 product of the residue
matrices to be exact (every partial sum stays below 2^24), and as many primes as the largest
possible score needs. Chinese remaindering with balanced digits gives back the signed score.

Anchors are a stated query set, scored against all rows in a grid of tasks: a block of anchors and
a split of the rows. Both are tables in the shared folder; a task streams its split and holds one
block, one chunk of scores and the best rows so far. Two passes: the first finds each anchor's
positives, only within labels; the second the negatives in each positive's window, of which a task
keeps the best few per anchor and positive, so what is shuffled does not grow with the pairs.

Defined cases: rows with a null id, label or vector or a null component take no part, nor do, in
:func:`integers`, non-finite ones; shorter vectors count as filled up with zeros; equal scores are
ordered by smaller id; rows that repeat an id are candidates and anchors as often as they occur, but
no positives of an anchor of that id, and of equal rows any order is the same; an anchor without
positives, or a positive without negatives, gives no row; an empty table gives an empty result;
other columns are not read. A score that could reach 2^55 fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchledger.llm.common import new_folder, releasing

#: Integers up to here are exact in float32.
EXACT = 1 << 24
#: No score may reach this: a hundred times a score is still a 64-bit integer.
MOST = 1 << 55
LOWEST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 10
    #: A negative's score, in hundredths of the positive's: from, to.
    window: tuple[int, int] = (30, 90)
    #: Bytes of an anchor block's components, and rows at most.
    block_bytes: int = 8 << 20
    block_rows: int = 16_384
    #: Rows that one task streams past a block; fewer where that would leave cores idle.
    split_rows: int = 1 << 20
    #: Scores held at a time.
    chunk: int = 1 << 21


def primes_for(dims: int, bound: int) -> list[int]:
    """Primes whose residues have exact products of ``dims`` terms, enough for scores up to ``bound``."""
    half = int((EXACT / max(dims, 1)) ** 0.5)
    while half * half * dims > EXACT:
        half -= 1
    out, product, p = [], 1, 2 * half + 1
    while product <= 2 * bound:
        if p < 2:
            raise ValueError(f"vectors of {dims} components have no residues for scores up to {bound}")
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            out.append(p)
            product *= p
        p -= 1
    return out


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p``, between -p/2 and p/2."""
    x = x % p
    return x - p * (x > p // 2)


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [balanced(x, p).astype(np.float32) for p in primes]


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``left`` with all of ``right``, as 64-bit integers.

    Mixed-radix digits of the signed value: each is the next prime's residue of what is left.
    """
    score, radix = None, 1
    for p, a, b in zip(primes, left, right):
        r = (a @ b.T).astype(np.int64)
        if score is None:
            score = balanced(r, p)
        else:
            digit = (r - balanced(score, p)) % p * pow(radix, -1, p)
            score += radix * balanced(digit, p)
        radix *= p
    return score


def integers(vec: str, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down, as longs; null for a vector with a null or non-finite one."""
    x = F.transform(vec, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")))


class _Best:
    """The best ``most`` rows of each of ``n`` groups: higher scores first, ties by smaller id."""

    def __init__(self, n: int, most: int, least: np.ndarray):
        self.most, self.least = most, least.copy()
        self.group = np.zeros(0, np.int64)
        self.score, self.id = self.group.copy(), self.group.copy()

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not group.size:
            return
        g, s, i = (np.concatenate(pair) for pair in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -s, g))
        g, s, i = g[order], s[order], i[order]
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        place = np.arange(g.size) - np.repeat(first, np.diff(np.append(first, g.size)))
        keep = place < self.most
        self.group, self.score, self.id = g[keep], s[keep], i[keep]
        full = place == self.most - 1
        self.least[g[full]] = np.maximum(self.least[g[full]], s[full])


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, lengths = column.flatten().to_numpy(), np.asarray(column.value_lengths())
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((lengths.size, dims), np.int64)
    row = np.repeat(np.arange(lengths.size), lengths)
    out[row, np.arange(flat.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


@lru_cache(maxsize=1)
def _block(path: str, block: int, dims: int, primes: tuple[int, ...]):
    """Slots, ids, labels and residues of a block of anchors, in order of labels."""
    fs, base = pafs.FileSystem.from_uri(path)
    rows = pq.read_table(f"{base}/block={block}", filesystem=fs, columns=["slot", "id", "label", "components"], partitioning=None)
    rows = rows.sort_by([("label", "ascending"), ("slot", "ascending")])
    slot, ids, label = (rows.column(c).to_numpy() for c in ("slot", "id", "label"))
    return slot, ids, label, residues(_matrix(rows.column("components"), dims), list(primes))


def _chunks(path: str, dims: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and components of a split; few rows first, so that thresholds rise early."""
    fs, base = pafs.FileSystem.from_uri(path)
    held = 64
    with fs.open_input_file(base) as file:
        for batch in pq.ParquetFile(file).iter_batches(batch_size=8192, columns=["id", "label", "components"]):
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(held, rows))
                yield part.column(0).to_numpy(), part.column(1).to_numpy(), _matrix(part.column(2), dims)
                at += part.num_rows
                held *= 4


def _runs(label: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Label, start and end of the runs of equal labels in order."""
    cut = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), label.size]
    for a, b in zip(cut[:-1], cut[1:]):
        if a < b:
            yield int(label[a]), a, b


def _positives(anchors, chunks, primes: list[int], p: Mining) -> _Best:
    """Each anchor's best rows of its label; only rows and anchors of one label are multiplied."""
    _, ids, label, own = anchors
    best = _Best(ids.size, p.positives, np.full(ids.size, LOWEST))
    runs = {k: (a, b) for k, a, b in _runs(label)}
    for row_ids, row_label, x in chunks:
        order = np.argsort(row_label, kind="stable")
        for k, c, d in _runs(row_label[order]):
            if k not in runs:
                continue
            a, b = runs[k]
            rows = order[c:d]
            score = products([r[a:b] for r in own], residues(x[rows], primes), primes)
            hit = (score >= best.least[a:b, None]) & (ids[a:b, None] != row_ids[None, rows])
            i, j = np.nonzero(hit)
            best.add(i + a, score[i, j], row_ids[rows][j])
    return best


def _negatives(anchors, windows, chunks, primes: list[int], p: Mining) -> list[_Best]:
    """For each anchor and positive the best rows of other labels whose score lies in the window."""
    _, ids, label, own = anchors
    best = [_Best(ids.size, p.negatives, low) for low, _ in windows]
    for row_ids, row_label, x in chunks:
        score = products(own, residues(x, primes), primes)
        score[label[:, None] == row_label[None, :]] = LOWEST
        for one, (_, high) in zip(best, windows):
            i, j = np.nonzero((score >= one.least[:, None]) & (score <= high[:, None]))
            one.add(i, score[i, j], row_ids[j])
    return best


def _grid(spark, blocks: list[int], files: list[str], run, schema: str) -> DataFrame:
    """``run(block, file)`` for each pair, a task each; blocks and files are numbered in its range."""
    total = len(blocks) * len(files)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0).to_pylist():
                yield from run(blocks[cell // len(files)], files[cell % len(files)])

    return spark.range(0, total, 1, max(total, 1)).mapInArrow(releasing(tasks), schema)


def _first(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The best rows of each group, numbered; Spark limits the groups before it shuffles them."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("other"))
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def mine(vectors: DataFrame, anchors: Column, p: Mining = Mining(), id_col: str = "id", label_col: str = "label", components_col: str = "components") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has integer components as an array of longs; ``anchors`` tells the anchors by their
    columns ``id`` and ``label``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(components_col).cast("array<long>").alias("components")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("components", lambda x: x.isNotNull()))
    at = new_folder(spark, "vectors")
    rows.write.parquet(f"{at}/all")
    rows = spark.read.schema(rows.schema).parquet(f"{at}/all")
    square = F.aggregate("components", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dims, square, n_anchors = rows.agg(
        F.count("*"), F.coalesce(F.max(F.size("components")), F.lit(0)), F.coalesce(F.max(square), F.lit(0.0)), F.count_if(anchors)
    ).first()
    if not square * 1.001 < MOST:
        raise ValueError(f"scores up to {square} are beyond what is exact")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], result)
    dims = max(dims, 1)
    primes = primes_for(dims, int(square * 1.001) + 1)  # no score is above the largest square of a vector
    most = max(1, min(p.block_rows, p.block_bytes // (8 * dims)))

    # Blocks: partitions of anchors, cut at the size of a block whatever their own.
    held = rows.where(anchors).repartition(-(-n_anchors // most)).withColumn("slot", F.monotonically_increasing_id())
    inside = F.col("slot").bitwiseAND(F.lit((1 << 33) - 1))
    held.withColumn("block", F.shiftright("slot", 33) * (1 << 20) + F.floor(inside / most)).write.partitionBy("block").parquet(f"{at}/anchors")
    blocks = [r.block for r in spark.read.parquet(f"{at}/anchors").select("block").distinct().collect()]
    splits = max(-(-n // p.split_rows), min(spark.sparkContext.defaultParallelism, -(-n // 4096)))
    rows.repartition(splits).write.option("maxRecordsPerFile", p.split_rows).parquet(f"{at}/splits")
    files = spark.read.parquet(f"{at}/splits").inputFiles()

    def anchors_of(block: int):
        return _block(f"{at}/anchors", block, dims, tuple(primes))

    def positives(block: int, file: str) -> Iterator[pa.RecordBatch]:
        own = anchors_of(block)
        best = _positives(own, _chunks(file, dims, max(64, p.chunk // own[0].size)), primes, p)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(best.group.size, block)), pa.array(own[0][best.group]), pa.array(best.id), pa.array(best.score)],
            names=["block", "slot", "other", "score"],
        )

    def probes(block: int, own: tuple) -> Iterator[tuple]:
        """For each place of a positive: the place, its id and score and its window, by anchor."""
        fs, base = pafs.FileSystem.from_uri(f"{at}/positives/block={block}")
        if fs.get_file_info(base).type == pafs.FileType.NotFound:
            return
        found = pq.read_table(base, filesystem=fs, partitioning=None)
        order = np.argsort(own[0])
        row = order[np.searchsorted(own[0], found.column("slot").to_numpy(), sorter=order)]
        place, score, other = (found.column(c).to_numpy() for c in ("place", "score", "other"))
        for k in range(1, p.positives + 1):
            this = place == k
            low, high, of, its = (np.zeros(own[0].size, np.int64) for _ in range(4))
            low += 1  # an empty window where there is no such positive
            low[row[this]] = -(-score[this] * p.window[0] // 100)
            high[row[this]] = score[this] * p.window[1] // 100
            of[row[this]], its[row[this]] = other[this], score[this]
            yield k, of, its, (low, high)

    def negatives(block: int, file: str) -> Iterator[pa.RecordBatch]:
        own = anchors_of(block)
        wanted = list(probes(block, own))
        best = _negatives(own, [w for *_, w in wanted], _chunks(file, dims, max(64, p.chunk // own[0].size)), primes, p)
        for one, (k, of, its, _) in zip(best, wanted):
            g = one.group
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[0][g]), pa.array(np.full(g.size, k, np.int32)), pa.array(own[1][g]), pa.array(of[g]), pa.array(its[g]), pa.array(one.id), pa.array(one.score)],
                names=["slot", "k", "anchor_id", "positive_id", "positive_score", "other", "score"],
            )

    top = _first(_grid(spark, blocks, files, positives, "block long, slot long, other long, score long"), ["block", "slot"], p.positives)
    top.repartition("block").write.partitionBy("block").parquet(f"{at}/positives")
    schema = "slot long, k int, anchor_id long, positive_id long, positive_score long, other long, score long"
    return _first(_grid(spark, blocks, files, negatives, schema), ["slot", "k"], p.negatives).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )

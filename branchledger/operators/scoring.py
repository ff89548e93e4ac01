"""Exact quantile scores over a whole table without a global sort.

The rows at which a tile begins are *selected*: brackets around each are narrowed by rounds of
map-side counts, first over ranges of the value, then, among rows of one value, over ranges of the
key. Once they are known a score is a comparison with a few constants, in one pass over the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from branchledger.session import shared_folder

#: Ranges of a bracket that a round counts, by value and by key.
VALUE_RANGES, KEY_RANGES = 4096, 32
#: Rows of a bracket that are few enough to be fetched and sorted.
FEW = 5000


@dataclass
class _Cut:
    """The row at place ``rank`` (from 0) of a bracket, in the order of value and key."""

    metric: str
    value: Column  # ascending, never null
    rank: int
    low: int
    high: int  # inclusive
    count: int
    after: Any = None  # the bracket's keys: beyond this one, up to that one
    upto: Any = None
    splitters: tuple = ()

    def inside(self, key: str) -> Column:
        held = (self.value >= self.low) & (self.value <= self.high)
        if self.after is not None:
            held &= F.col(key) > F.lit(self.after)
        if self.upto is not None:
            held &= F.col(key) <= F.lit(self.upto)
        return held

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // VALUE_RANGES)

    def range_of(self, key: str) -> Column:
        """The number of a row's range in the bracket."""
        if self.low < self.high:
            return F.expr(f"int(({self.metric_name} - {self.low}L) div {self.width}L)")
        beyond = [(F.col(key) > F.lit(s)).cast("int") for s in self.splitters]
        return sum(beyond[1:], beyond[0])

    @property
    def metric_name(self) -> str:
        return f"`__{self.metric}`"

    def narrow(self, counts: dict[int, int]) -> None:
        before = 0
        for at in sorted(counts):
            if before + counts[at] > self.rank:
                break
            before += counts[at]
        self.rank, self.count = self.rank - before, counts[at]
        if self.low < self.high:
            self.low, self.high = self.low + at * self.width, min(self.high, self.low + (at + 1) * self.width - 1)
        else:
            bounds = [self.after, *self.splitters, self.upto]
            self.after, self.upto = bounds[at], bounds[at + 1]


def _per_cut(df: DataFrame, cuts: list[_Cut], key: str, *columns) -> DataFrame:
    """A row per cut and row of its bracket: ``cut`` and what each of ``columns`` gives for it."""
    cells = [
        F.when(c.inside(key), F.struct(F.lit(i).alias("cut"), *[make(c).alias(name) for name, make in columns]))
        for i, c in enumerate(cuts)
    ]
    return df.select(F.inline(F.array_compact(F.array(*cells))))


def _split_keys(df: DataFrame, cuts: list[_Cut], key: str) -> None:
    """Keys that part each bracket evenly, from those of its rows that a hash chooses."""
    def chosen(c: _Cut) -> Column:
        share = max(1, c.count // (8 * KEY_RANGES))
        return F.when(F.pmod(F.xxhash64(key), F.lit(share)) == 0, F.col(key))

    found = _per_cut(df, cuts, key, ("key", chosen)).where("key is not null").collect()
    for i, c in enumerate(cuts):
        own = sorted({r.key for r in found if r.cut == i} - {c.upto})
        step = max(1, len(own) // KEY_RANGES)
        c.splitters = tuple(own[step // 2 :: step])


def cut_rows(df: DataFrame, metrics: Mapping[str, Column], key: str, ranks: list[int], most: int = FEW) -> dict[str, list[tuple[int, Any]]]:
    """Per metric the (value, key) at each place of ``ranks``, in the order of value and key.

    ``df`` should be a table: every round reads it. Keys are unique and not null.
    """
    df = df.select(key, *[v.cast("long").alias(f"__{m}") for m, v in metrics.items()])
    own = {m: F.col(f"__{m}") for m in metrics}
    ends = df.agg(F.count(F.lit(1)).alias("n"), *[f(own[m]).alias(f"{name}_{m}") for m in metrics for name, f in (("low", F.min), ("high", F.max))]).first()
    cuts = [_Cut(m, own[m], r, ends[f"low_{m}"], ends[f"high_{m}"], ends.n) for m in metrics for r in ranks]
    while wide := [c for c in cuts if c.count > most]:
        if tied := [c for c in wide if c.low == c.high]:
            _split_keys(df, tied, key)
        wide = [c for c in wide if c.low < c.high or c.splitters]
        counted = _per_cut(df, wide, key, ("at", lambda c: c.range_of(key))).groupBy("cut", "at").count().collect()
        for i, c in enumerate(wide):
            c.narrow({r.at: r["count"] for r in counted if r.cut == i})
    rows = _per_cut(df, cuts, key, ("value", lambda c: c.value), ("key", lambda _: F.col(key))).collect() if cuts else []
    held: list[list[tuple]] = [[] for _ in cuts]
    for r in rows:
        held[r.cut].append((r.value, r.key))
    out: dict[str, list[tuple[int, Any]]] = {m: [] for m in metrics}
    for c, own_rows in zip(cuts, held):
        out[c.metric].append(sorted(own_rows)[c.rank])
    return out


def tile_starts(rows: int, bins: int) -> list[int]:
    """Where tiles 2..bins begin: the first ``rows % bins`` tiles hold one row more."""
    size, larger = divmod(rows, bins)
    return [i * size + min(i, larger) for i in range(1, bins)]


def quintile_scores(
    df: DataFrame, metrics: Mapping[str, str], key: str, bins: int = 5
) -> DataFrame:
    """Add ``<metric>_score`` (1..bins, the tiles of ``ntile``) for each metric.

    ``metrics`` maps an integer column to ``asc`` (large is good) or ``desc`` (small is good); the
    unique ``key`` breaks ties, nulls rank lowest for ``asc`` and last for ``desc``. ``df`` is
    evaluated once, into a table that the rounds and the result read.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/scored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    ends = table.agg(F.count(F.lit(1)).alias("n"), *[f(m).alias(f"{name}_{m}") for m in metrics for name, f in (("low", F.min), ("high", F.max))]).first()
    values = {}
    for m, direction in metrics.items():
        low, high = ends[f"low_{m}"] or 0, ends[f"high_{m}"] or 0
        values[m] = F.coalesce(F.col(m), F.lit(low - 1)) if direction == "asc" else -F.coalesce(F.col(m), F.lit(low - 1))
    starts = [r for r in tile_starts(ends.n, bins) if r < ends.n]
    cuts = cut_rows(table, values, key, starts) if starts else {m: [] for m in metrics}

    def score(m: str) -> Column:
        reached = [
            ((values[m] > v) | ((values[m] == v) & (F.col(key) >= F.lit(k)))).cast("bigint") for v, k in cuts[m]
        ]
        return sum(reached, F.lit(1).cast("bigint"))

    return table.withColumns({f"{m}_score": score(m) for m in metrics})

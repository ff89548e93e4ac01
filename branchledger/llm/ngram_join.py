"""N-gram Jaccard join: size-aware heavy-light join of word-shingle sets, exact.

Two documents link when ``intersection / union >= num / den`` of their shingle sets.

* Documents with equal sets are one set from here on, named by 64 bits of a digest. Names that
  stand for several sets, by another 64 bits, are found first and replaced by those. A task gives a
  set's keys once, however many copies it meets.
* A *light* set enumerates fixed-size subsets: a partner of size m shares at least
  ``ceil(num * m / den)`` shingles, so both list all their subsets of that size as keys.
* A *heavy* set looks through inverted lists. Only the lists of its rarest
  ``n - ceil(num * n / den) + 1`` shingles are needed: two linked sets share one of them. Rarity
  comes from a count sketch of fixed size; a rough count costs time, never a link.
* The boundary between light and heavy is the largest size whose subsets cost less than its lists.
* Keys that several sets share bring them together. Sizes and the places of the shared shingle
  in both sets bound an intersection; sets with no possible partner on a list leave it. A short
  list then compares its sets' parity
  bitmaps, whose difference is a lower bound of the sets' difference, so only pairs that cannot
  link are dropped; a long list, in order of size, ties each set to the one before where their sizes
  let them link, which joins all pairs that may. That yields groups of candidates,
  connected components found by star rounds. Groups are cut into blocks of bounded size; each
  pair of blocks scans the inverted lists of its own sets and counts every intersection exactly.

No pair is ever a row: tasks return spanning forests and degrees. Memory is bounded by the
block size, the sketch by its width.

Defined cases: a text without words (null, empty, white space) has no shingle and no link; a text
with fewer words than a shingle is one shingle of all its words; rows are kept as they come, so
repeated rows give repeated results and equal texts link; a null id takes part in its component
but never names it; an empty table gives an empty result; columns besides the two named ones are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchledger.llm.common import as_bytes, collided, components, filter_bit, grouped, let_pass, passing, releasing, row_filter, told_apart, written
from branchledger.llm.hashing import chunks, mix, shingle_sets


@dataclass(frozen=True)
class Join:
    """Parameters: shingle length, similarity ``num / den`` and bounds on memory."""

    words: int = 5
    num: int = 80
    den: int = 100
    #: Counters of the sketch; its memory and its broadcast are fixed by this.
    counters: int = 1 << 22
    #: Lists up to this length compare bitmaps of all their sets inside the task; longer ones stream by.
    short_list: int = 64
    #: Shingles of one block of a candidate group.
    block: int = 1_000_000
    #: Sets up to this size may be light; the cost decides.
    most_light: int = 16

    def least(self, n: int) -> int:
        """The least intersection of a set of n with a set it links to that is not larger."""
        return -(-self.num * n // self.den)

    def largest(self, n: int) -> int:
        return self.den * n // self.num

    def prefix(self, n: int) -> int:
        return n - self.least(n) + 1

    def subsets(self, n: int) -> int:
        return sum(math.comb(n, self.least(m)) for m in range(n, self.largest(n) + 1))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    """A set's name and another, independent one."""
    both = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(both[:8], "little", signed=True), int.from_bytes(both[8:], "little", signed=True)


def _name(tokens: np.ndarray, several: frozenset[int]) -> int:
    name, other = _digest(tokens)
    return other if name in several else name


def _bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the shingles per bit, at least as many bits as shingles, a power of two."""
    bits = 1 << max(7, min(20, int(tokens.size - 1).bit_length()))
    parity = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles in just one of two sets, from their bitmaps."""
    if len(a) > len(b):
        a, b = b, a
    x, y, bits = int.from_bytes(a, "little"), int.from_bytes(b, "little"), len(a) * 8
    while y >> bits:
        y, high = y & ((1 << bits) - 1), y >> bits
        while high:
            y ^= high & ((1 << bits) - 1)
            high >>= bits
    return (x ^ y).bit_count()


SCAN = "kind string, id long, n int, sid long, other long, payload binary"


def _scan(p: Join):
    """Per text its set's size, digest and bitmap; per task the counts of its shingles."""
    span = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(p.counters, np.uint32)
        held: list[np.ndarray] = []

        def settle() -> None:
            if held:
                at = (np.concatenate(held) >> np.uint64(64 - (p.counters - 1).bit_length())).view(np.int64)
                held.clear()
                np.add(counts, np.bincount(at, minlength=p.counters), out=counts, casting="unsafe")

        for batch in batches:
            ids, texts = batch.column(0), as_bytes(batch.column(1))
            for first, part in chunks(texts):
                sets = shingle_sets(part, p.words)
                held.extend(sets)
                if sum(map(len, held)) > 1_000_000:
                    settle()
                names = [_digest(s) if s.size else (None, None) for s in sets]
                yield _rows(
                    ["doc"] * len(sets),
                    ids.slice(first, len(sets)).cast(pa.int64()),
                    [s.size for s in sets],
                    [name for name, _ in names],
                    [other for _, other in names],
                    [_bitmap(s) if s.size else None for s in sets],
                )
        settle()
        blocks = counts.reshape(-1, span)
        full = np.flatnonzero(blocks.any(axis=1))
        for a in range(0, full.size, 128):
            some = full[a : a + 128].tolist()
            packed = [zlib.compress(np.minimum(blocks[i], 65535).astype("<u2").tobytes(), 1) for i in some]
            none = [None] * len(some)
            yield _rows(["count"] * len(some), pa.array(some, pa.int64()), [0] * len(some), none, none, packed)

    return run


def _rows(kind, ids, n, sid, other, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.string()), ids, pa.array(n, pa.int32()), pa.array(sid, pa.int64()), pa.array(other, pa.int64()), pa.array(payload, pa.binary())],
        names=["kind", "id", "n", "sid", "other", "payload"],
    )


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the tasks' counts, by block, on a logarithmic scale in one byte."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(zlib.decompress(packed), "<u2").astype(np.int64)
            total[i] = total[i] + own if i in total else own
    if total:
        levels = [np.minimum(255, np.rint(8 * np.log2(1 + c))).astype(np.uint8).tobytes() for c in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(levels, pa.binary())], names=["id", "levels"])


def _sketch(scanned: DataFrame, p: Join) -> np.ndarray:
    """The sketch: one byte for each of ``p.counters`` counters, whatever the corpus."""
    spark = scanned.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = (
        scanned.where("kind = 'count'").select("id", "payload").repartition(parts, "id")
        .mapInArrow(_add_counts, "id long, levels binary")
    )
    out = np.zeros(p.counters, np.uint8)
    for row in sums.collect():  # p.counters bytes in all
        out[row.id * 4096 : row.id * 4096 + 4096] = np.frombuffer(row.levels, np.uint8)
    return out


def boundary(sizes: dict[int, int], list_length: float, p: Join) -> int:
    """The largest size of a light set. ``sizes``: sets by size; ``list_length``: mean list.

    Enumerating costs a key per subset; looking through lists costs the prefix and, for each of
    its shingles, the list's other sets. A size counts as light while all smaller sizes are.
    """
    best = 0
    for n in range(1, p.most_light + 1):
        if p.subsets(n) > p.prefix(n) * (1 + list_length) and sizes.get(n, 0):
            break
        best = n
    return best


def _keys(p: Join, light: int, sketch, several: frozenset[int], remembered: int = 500_000):
    """(key, sid, size and place) of every set: subsets if light, rarest shingles if heavy or next to it.

    A task gives them once a set as long as it remembers the set's name; equal texts that lie in
    different tasks give them again.

    ``place`` is the shingle's rank in the set, 0 for a subset; it shares a number with the size.
    """
    shift = np.uint64(64 - (p.counters - 1).bit_length())

    def subsets(tokens: np.ndarray) -> list[np.ndarray]:
        n, out = tokens.size, []
        for m in range(n, min(light, p.largest(n)) + 1):
            c = p.least(m)
            rows = np.array(list(combinations(range(n), c)), np.int64)
            mixed = mix(tokens)[rows]
            salt = np.uint64(m * 0x5851F42D4C957F2D % 2**64)
            out.append(mix(mix(mixed.sum(axis=1, dtype=np.uint64)) + salt) | np.uint64(1 << 63))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, met = sketch.value, set()
        for batch in batches:
            for _, part in chunks(as_bytes(batch.column(0))):
                keys, sids, places = [], [], []
                for tokens in shingle_sets(part, p.words):
                    n = tokens.size
                    if not n or (name := _name(tokens, several)) in met:
                        continue
                    if len(met) >= remembered:
                        met.clear()
                    met.add(name)
                    own = subsets(tokens) if n <= light else []
                    at = [np.zeros(sum(x.size for x in own), np.int64)]
                    if n > light or p.largest(n) > light:
                        ranked = (levels[(tokens >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(55)) | (mix(tokens) >> np.uint64(9))
                        k = p.prefix(n)
                        own.append(np.sort(np.partition(ranked, k - 1)[:k] if k < n else ranked))
                        at.append(np.arange(k))
                    key = np.concatenate(own)
                    keys.append(key)
                    sids.append(name)
                    places.append((n << 32) + np.concatenate(at))
                if keys:
                    lengths = [k.size for k in keys]
                    arrays = [_signed(np.concatenate(keys)), np.repeat(np.array(sids, np.int64), lengths), np.concatenate(places)]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["key", "sid", "place"])

    return run


def _shared_keys(p: Join):
    """From rows sorted by key, size, place and set: members of short shared lists, ties of long ones.

    Holds ``short_list`` sets at most; a longer list is passed on as it streams by. Sets that may
    link have sizes that may, and so have all neighbours between them in order of size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, held, end = None, None, [], None
        out: tuple[list, list, list] = ([], [], [])

        def put(k, a, n) -> None:
            out[0].append(k), out[1].append(a), out[2].append(n)

        def tie(one, two) -> None:
            if p.den * (one[1] >> 32) >= p.num * (two[1] >> 32):
                put(one[0], two[0], -1)

        def close() -> None:
            if end is None and len(held) > 1:
                own = sorted((place >> 32, place & 0xFFFFFFFF, sid) for sid, place in held)
                stay = [False] * len(own)
                for y, (m, j, _) in enumerate(own):
                    for x in range(y - 1, -1, -1):
                        n, i, _ = own[x]
                        if p.den * n < p.num * m:
                            break
                        if (p.num + p.den) * min(n - i, m - j) >= p.num * (n + m):
                            stay[x] = stay[y] = True
                for (n, _, sid), s in zip(own, stay):
                    if s:
                        put(key, sid, n)

        def batch_out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], names=["key", "sid", "n"])
            for x in out:
                x.clear()
            return made

        for batch in batches:
            keys = batch.column(0).to_numpy()
            sids = batch.column(1).to_numpy()
            places = batch.column(2).to_numpy()
            # Keys of a single row, almost all, are passed over without a Python step.
            alone = np.ones(keys.size, bool)
            alone[1:] &= keys[1:] != keys[:-1]
            alone[:-1] &= keys[1:] != keys[:-1]
            if keys.size:
                alone[0] = alone[-1] = False
            at = np.flatnonzero(~alone)
            for k, s, place in zip(keys[at].tolist(), sids[at].tolist(), places[at].tolist()):
                if k != key:
                    close()
                    key, last, held, end = k, None, [], None
                if s == last:
                    continue
                last = s
                if end is not None:
                    tie(end, (s, place))
                    end = s, place
                    continue
                held.append((s, place))
                if len(held) > p.short_list:
                    end = held[-1]
                    for one, two in zip(held, held[1:]):
                        tie(one, two)
            if len(out[0]) >= 50_000:
                yield batch_out()
        close()
        yield batch_out()

    return run


def _may_link(p: Join):
    """Ties within short lists: pairs whose bitmaps leave a link possible, as a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_out: list[int] = []
        b_out: list[int] = []
        tied: set[tuple[int, int]] = set()  # ties this task has already given
        for table in grouped(batches, ["key"]):
            rows = sorted(zip(table.column("n").to_pylist(), table.column("sid").to_pylist(), table.column("bitmap").to_pylist()))
            root = list(range(len(rows)))
            if len(tied) > 1_000_000:
                tied.clear()

            def find(i: int) -> int:
                while root[i] != i:
                    root[i] = i = root[root[i]]
                return i

            for j, (m, sid, bitmap) in enumerate(rows):
                for i in range(j - 1, -1, -1):
                    n = rows[i][0]
                    if p.den * n < p.num * m:
                        break
                    x, y = find(i), find(j)
                    if x == y:
                        continue
                    if (rows[i][1], sid) in tied:
                        root[max(x, y)] = min(x, y)
                        continue
                    # A link's sets differ in at most this share of their sizes' sum.
                    if (p.num + p.den) * _apart(rows[i][2], bitmap) <= (p.den - p.num) * (n + m):
                        root[max(x, y)] = min(x, y)
                        a_out.append(rows[i][1]), b_out.append(sid)
                        tied.add((rows[i][1], sid))
            if len(a_out) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])
                a_out, b_out = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return run


def _sets(p: Join, wanted, several: frozenset[int]):
    """Digest and bytes of the sets of texts that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array(passing(wanted.value, batch.column(0).to_numpy())))
            for _, part in chunks(as_bytes(kept.column(1))):
                sets = [s for s in shingle_sets(part, p.words) if s.size]
                yield pa.RecordBatch.from_arrays([pa.array([_name(s, several) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["sid", "tokens"])

    return run


def scan_lists(sets: list[np.ndarray], side: np.ndarray, two: bool, weight: np.ndarray, p: Join) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links among sets of one block or, with ``two``, between two (sides 0 and 1, either may be empty).

    For each set the inverted lists of all its shingles are scanned, which counts its exact
    intersection with every other set. Returns a spanning forest and each set's linked weight.
    """
    size = np.array([s.size for s in sets], np.int64)
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    new = np.ones(token.size, bool)
    new[1:] = token[1:] != token[:-1]
    ends = np.append(np.flatnonzero(new)[1:], token.size)[np.cumsum(new) - 1]
    by_owner = np.argsort(owner, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(size)])
    root, forest = list(range(len(sets))), []
    degree = np.zeros(len(sets), np.int64)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(len(sets)):
        at = by_owner[bounds[i] : bounds[i + 1]]
        count = ends[at] - at - 1  # the list's later sets
        if not (total := int(count.sum())):
            continue
        places = np.repeat(at + 1 - (np.cumsum(count) - count), count) + np.arange(total)
        shared = np.bincount(owner[places], minlength=len(sets))
        linked = p.den * shared >= p.num * (size[i] + size - shared)
        linked &= shared > 0
        if two:
            linked &= side != side[i]
        for j in np.flatnonzero(linked).tolist():
            degree[i] += weight[j]
            degree[j] += weight[i]
            x, y = find(i), find(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                forest.append((i, j))
    return forest, degree


def _verify(p: Join):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["grp", "one", "two"]):
            # Rows that share the id by which the filter chose them can give a set more than once.
            _, first = np.unique(table.column("sid").to_numpy(), return_index=True)
            table = table.take(pa.array(first))
            sids = table.column("sid").to_pylist()
            sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
            side = (table.column("own").to_numpy() != table.column("one").to_numpy()).astype(np.int8)
            two = table.column("one")[0] != table.column("two")[0]
            if two and side.min() == side.max():  # one of the blocks holds no set
                continue
            forest, degree = scan_lists(sets, side, two, table.column("copies").to_numpy(), p)
            linked = np.flatnonzero(degree).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([sids[i] for i, _ in forest] + [sids[i] for i in linked], pa.int64()),
                    pa.array([sids[j] for _, j in forest] + [None] * len(linked), pa.int64()),
                    pa.array([0] * len(forest) + degree[linked].tolist(), pa.int64()),
                ],
                names=["a", "b", "links"],
            )

    return run


def jaccard_classes(docs: DataFrame, p: Join, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (smallest linked id), n_links (rows linked to)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    scanned = written(texts.mapInArrow(releasing(_scan(p)), SCAN), "ngram-scan")
    rows = scanned.where("kind = 'doc'").select("id", "n", "sid", "other", "payload")
    several = collided(rows.where("sid is not null"), "sid", "other")
    rows, several = rows.withColumn("sid", told_apart("sid", "other", several)).drop("other"), frozenset(several)

    sketch = _sketch(scanned, p)
    small = {r.n: r.c for r in rows.where(f"n between 1 and {p.most_light}").groupBy("n").agg(F.count("*").alias("c")).collect()}
    # A list's expected other sets: the mean count of the sketch's rarer half, less its own.
    rare = np.sort(sketch[:: max(1, p.counters // 65536)])[: 32768]
    light = boundary(small, float(np.mean(2.0 ** (rare / 8.0) - 1)), p)

    ranks = spark.sparkContext.broadcast(sketch)
    keys = texts.select("text").mapInArrow(releasing(_keys(p, light, ranks, several)), "key long, sid long, place long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = written(
        keys.repartition(parts, "key").sortWithinPartitions("key", "place", "sid")
        .mapInArrow(_shared_keys(p), "key long, sid long, n int"),
        "ngram-shared",
    )
    sets = rows.where("sid is not null").groupBy("sid").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"), F.max("payload").alias("bitmap")
    )
    short = shared.where("n > 0").select("key", "sid").join(sets.select("sid", "n", "bitmap"), "sid")
    near = short.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_may_link(p), "a long, b long")
    ties = near.union(shared.where("n < 0").selectExpr("key a", "sid b"))
    groups = components(ties, "ngram-groups").withColumnsRenamed({"node": "sid", "root": "grp"})

    members = groups.join(sets.select("sid", "first", "copies", "n"), "sid")
    blocks = members.groupBy("grp").agg(F.ceil(F.sum("n") / p.block).cast("int").alias("blocks"))
    members = written(
        members.join(blocks, "grp").withColumn("own", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
        .select("grp", "sid", "first", "copies", "own", "blocks"),
        "ngram-members",
    )
    ranged = F.expr("transform(sequence(0, blocks - 1), x -> struct(least(own, x) one, greatest(own, x) two))")
    # Sets of the members' first documents; others that slip through the filter fall to the join.
    wanted = spark.sparkContext.broadcast(row_filter(members, "first"))
    found = texts.select(filter_bit("id").alias("bit"), "text").mapInArrow(releasing(_sets(p, wanted, several)), "sid long, tokens binary")
    tokens = found.join(members, "sid")
    units = tokens.withColumn("unit", F.explode(ranged)).select("grp", "unit.one", "unit.two", "sid", "copies", "own", "tokens")
    linked = written(
        units.repartition(parts, "grp", "one", "two").sortWithinPartitions("grp", "one", "two")
        .mapInArrow(releasing(_verify(p)), "a long, b long, links long"),
        "ngram-links",
    )
    roots = components(linked.where("b is not null").select("a", "b"), "ngram-roots")
    degree = linked.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    named = (
        sets.select("sid", "first", "copies")
        .join(roots.withColumnRenamed("node", "sid"), "sid", "left")
        .join(degree.withColumnRenamed("a", "sid"), "sid", "left")
        .withColumn("root", F.coalesce("root", "sid"))
    )
    named = written(named, "ngram-named")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(lowest, "root").select("sid", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    empty = rows.where("sid is null").selectExpr("id", "cast(n as long) n_shingles", "id component_id", "0L n_links")
    full = rows.where("sid is not null").join(classes, "sid").selectExpr("id", "cast(n as long) n_shingles", "component_id", "n_links")
    return full.unionByName(empty).withColumnRenamed("id", id_col)


def one_of_each(docs: DataFrame, p: Join, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, less all but the one with the smallest id of each component.

    A null id loses against any other. Of rows with the same id in a component the one with the
    smallest key of its content stays; rows that are equal in id and text stay or go together.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    content = F.col(id_col), F.coalesce(text_col, F.lit("")), F.isnull(text_col)
    keyed = docs.select(row, F.xxhash64(*content).alias("key"), F.xxhash64(F.lit(7), *content[::-1]).alias("other"))
    several = collided(keyed.select("key", "other"), "key", "other")
    keyed = keyed.withColumn("key", told_apart("key", "other", several)).drop("other")
    classes = jaccard_classes(keyed.select("key", F.col("row").getField(text_col).alias("text")), p, "key")
    linked = classes.where("n_links > 0").select("key", "component_id").distinct()
    ids = keyed.select(F.col("key").alias("of"), F.col("row").getField(id_col).alias("id"))
    members = written(linked.join(ids, F.col("key") == F.col("of")).select("key", "component_id", "id").distinct(), "ngram-classes")
    order = F.struct(F.isnull("id").alias("unnamed"), "id", "key")
    stay = members.groupBy("component_id").agg(F.min(order).getField("key").alias("stay"))
    gone = written(members.join(stay, "component_id").where("key <> stay").select("key"), "ngram-gone")
    wanted = docs.sparkSession.sparkContext.broadcast(row_filter(gone, "key"))
    some, other = let_pass(keyed, wanted, "key"), let_pass(keyed, wanted, "key", keep=False)
    return some.join(gone, "key", "left_anti").unionByName(other).select("row.*")

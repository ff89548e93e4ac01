"""Removal of passages that repeat anywhere in the corpus, found by sorting suffixes.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else. Sorting
every suffix of the corpus is not needed. Of each window of ``length`` bytes the *anchor* is the
``gram``-byte string in it with the least hash, the leftmost one. Equal windows have their anchors
at the same place, so windows need comparing only around equal anchors, about one in
``(length - gram) / 2`` positions.

1. Anchors are dealt by hash; those that occur once are dropped as they stream by.
2. Each remaining anchor gives its context: the bytes of all windows it is the anchor of. Equal
   contexts are counted, first within a batch, then within the anchor's group, and held once.
3. In a group the texts right of the anchor and, reversed, those left of it are ordered by
   deep-shallow sorting: multikey quicksort to a shallow depth, blind tries for what is still
   equal there. The common prefixes of neighbours in both orders tell how far any two contexts
   agree, hence which windows repeat.
4. Repeated windows become byte ranges of the documents, which are merged and cut out.

An anchor's group holds its distinct contexts only, however many copies there are; a document's
anchors are bounded by its length. Only documents with a repeated anchor are dealt.

A *hot* anchor, such as a common line with ever different surroundings, is split over tasks. Two
contexts share a window if they agree in ``length - gram`` bytes beside the anchor, ``i`` to its left
and the rest to its right. So they agree, for one of ``parts`` steps of ``i``, in the step's bytes to the
left and what the next step leaves to the right: a context goes to one group per step, keyed by
these bytes, and every pair that shares a window meets in one of them.

Equal contexts, most of what repeats, are found equal as they are counted, and two contexts are
compared directly; sorting orders groups of three and more.

Defined cases: null text is empty; matches never cross documents; a text shorter than ``length``
is never cut; rows with equal ids are separate documents, and repeated rows repeat all their text;
ids may be null; an empty table gives an empty result; other columns are kept and may have any
names. A cut inside a character leaves invalid bytes in ``kept``; as text they are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchledger.llm.common import as_bytes, filter_bit, let_pass, passing, releasing, row_filter, sliced, written
from branchledger.llm.hashing import mix

_rng = np.random.Generator(np.random.PCG64(7))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_P = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    gram: int = 64
    #: Bytes multikey quicksort looks at beyond the known common prefix.
    shallow: int = 8
    #: Up to so many contexts, an anchor's contexts are compared by pairs of neighbours in order.
    few: int = 24
    #: Anchors of more rows than this are split, by so many steps; up to so many anchors, the hottest.
    hot: int = 10_000
    parts: int = 4
    most_hot: int = 5_000
    #: Bytes handled at a time by the anchor search.
    chunk: int = 1 << 20

    @property
    def width(self) -> int:
        return self.length - self.gram + 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, _P, np.uint64), np.full(size, pow(_P, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if rest := width - span:
        x = np.minimum(x[:-rest], x[rest:])
    return x


def anchors(data: np.ndarray, ends: np.ndarray, p: Repeats) -> tuple[np.ndarray, ...]:
    """Hash, place, first and last window of every anchor. ``ends``: of each byte's document."""
    n = data.size - p.length + 1
    if n <= 0:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    up, down = _powers(data.size + 1)
    total = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: data.size], out=total[1:])
    hashed = mix((total[p.gram :] - total[: -p.gram]) * down[: data.size - p.gram + 1])
    place = np.arange(hashed.size, dtype=np.uint64)
    found = _least((hashed & np.uint64(~0xFFFFFF & (2**64 - 1))) | place, p.width)[:n]
    start = np.flatnonzero(ends[:n] - np.arange(n) >= p.length)
    if not start.size:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    own = (found[start] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.ones(own.size, bool)
    new[1:] = own[1:] != own[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], own.size) - 1
    return hashed[own[first]], own[first], start[first], start[last]


def _documents(texts: list[bytes], p: Repeats) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors of many texts: index of text, hash, place, first and last window in the text.

    Short texts are searched together, a long one in pieces that overlap by a window.
    """
    held: list[int] = []
    size = 0

    def search(which: list[int]):
        data = np.frombuffer(b"".join(texts[i] for i in which), np.uint8)
        lengths = np.array([len(texts[i]) for i in which])
        ends = np.cumsum(lengths)
        hashed, at, lo, hi = anchors(data, np.repeat(ends, lengths), p)
        text = np.searchsorted(ends, at, side="right")
        begin = (ends - lengths)[text]
        return np.array(which)[text], hashed, at - begin, lo - begin, hi - begin

    for i, text in enumerate(texts):
        if len(text) > p.chunk:
            for a in range(0, len(text) - p.length + 1, p.chunk):
                piece = np.frombuffer(text, np.uint8)[a : a + p.chunk + p.length - 1]
                hashed, at, lo, hi = anchors(piece, np.full(piece.size, piece.size), p)
                yield np.full(at.size, i), hashed, at + a, lo + a, hi + a
        elif len(text) >= p.length:
            held.append(i)
            size += len(text)
            if size >= p.chunk:
                yield search(held)
                held, size = [], 0
    if held:
        yield search(held)


def _find_anchors(p: Repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in as_bytes(batch.column(2))]
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for text, hashed, at, lo, hi in _documents(texts, p):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (hashed.view(np.int64), k1[text], k2[text], lo, (at - lo).astype(np.int16), (hi - lo).astype(np.int16))],
                    names=["h", "k1", "k2", "lo", "a", "w"],
                )

    return run


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor, those whose anchor occurs again. Holds one batch and a row."""
    waiting, last = None, None  # the row that may yet repeat, unless it was given; its anchor
    for batch in batches:
        h = batch.column(0).to_numpy()
        if not h.size:
            continue
        again = np.append(last is not None and last == h[0], h[1:] == h[:-1])
        keep = again.copy()
        keep[:-1] |= again[1:]
        if again[0] and waiting is not None:
            yield waiting
        yield batch.filter(pa.array(keep))
        if h.size > 1 or not again[0]:
            waiting = None
        if not keep[-1]:
            waiting = batch.slice(h.size - 1, 1)
        elif again[0]:
            waiting = None
        last = h[-1]


CONTEXTS = "h long, a int, context binary, copies long, k1 long, k2 long, lo long, x1 long, x2 long"


def _contexts(p: Repeats):
    """Contexts of the documents' repeated anchors, equal ones of a slice counted together.

    Besides, each one's document, place and context digest; those rows have no context.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            seen: dict[tuple[int, int, bytes], int] = {}
            rows: list[tuple] = []
            k1, k2, texts, places = (batch.column(batch.schema.get_field_index(c)) for c in ("k1", "k2", "text", "places"))
            for one, two, text, own in zip(k1.to_pylist(), k2.to_pylist(), as_bytes(texts), places.to_pylist()):
                for h, lo, a, w in ((x["h"], x["lo"], x["a"], x["w"]) for x in own):
                    context = text[lo : lo + w + p.length]
                    seen[h, a, context] = seen.get((h, a, context), 0) + 1
                    rows.append((one, two, lo, *_digest(h, a, context)))
            n, places_of = len(seen), list(zip(*rows)) or [()] * 5
            if not n:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in seen], pa.int64()), pa.array([x[1] for x in seen], pa.int32()),
                    pa.array([x[2] for x in seen], pa.binary()), pa.array(list(seen.values()), pa.int64()),
                    *[pa.nulls(n, pa.int64())] * 5,
                ],
                names=["h", "a", "context", "copies", "k1", "k2", "lo", "x1", "x2"],
            )
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), *(pa.array(c, pa.int64()) for c in places_of)],
                names=["h", "a", "context", "copies", "k1", "k2", "lo", "x1", "x2"],
            )

    return run


def _digest(h: int, a: int, context: bytes) -> tuple[int, int]:
    both = xxhash.xxh3_128_digest(context, seed=(h ^ a * _P) & (2**64 - 1))
    return int.from_bytes(both[:8], "little", signed=True), int.from_bytes(both[8:], "little", signed=True)


def common(x: bytes, y: bytes, start: int = 0) -> int:
    """Length of the common prefix, given that the first ``start`` bytes agree."""
    n = min(len(x), len(y))
    x, y = x[start:n], y[start:n]
    if x == y:
        return n
    apart = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (apart.bit_length() + 7) // 8


class _Trie:
    """A blind trie: inner nodes hold only where their strings part; leaves are sets of equals."""

    __slots__ = ("depth", "below", "ended", "leaf")

    def __init__(self, leaf: int):
        self.depth, self.below, self.ended, self.leaf = -1, {}, [leaf], leaf


def _blind(which: list[int], texts: list[bytes], depth: int) -> list[int]:
    """Order of strings that agree up to ``depth``, by insertion into a blind trie."""
    root = _Trie(which[0])
    for i in which[1:]:
        text, node = texts[i], root
        while node.depth >= 0 and node.depth < len(text) and text[node.depth] in node.below:
            node = node.below[text[node.depth]]
        # Blind descent has skipped bytes; the leaf it came to tells where the string leaves.
        other = texts[node.leaf]
        leaves = common(text, other, depth)
        node = root
        while node.depth >= 0 and node.depth < leaves:
            node = node.below[text[node.depth]]
        if node.depth == leaves:
            if leaves == len(text):
                node.ended.append(i)
            else:
                node.below[text[leaves]] = _Trie(i)
        elif node.depth < 0 and leaves == len(text) == len(texts[node.leaf]):
            node.ended.append(i)
        else:
            old = _Trie(node.leaf)
            old.depth, old.below, old.ended = node.depth, node.below, node.ended
            node.depth, node.below, node.ended = leaves, {}, []
            if leaves == len(other):
                node.ended = old.ended
            else:
                node.below[other[leaves]] = old
            if leaves == len(text):
                node.ended = [*node.ended, i]
            else:
                node.below[text[leaves]] = _Trie(i)
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        out.extend(node.ended)
        stack.extend(node.below[c] for c in sorted(node.below, reverse=True))
    return out


def deep_shallow(texts: list[bytes], known: int, shallow: int) -> tuple[list[int], list[int]]:
    """Order of strings that agree in ``known`` bytes, and each one's common prefix with the last.

    Multikey quicksort splits by one byte at a time, up to ``shallow`` bytes; blind tries order
    what is equal that far.
    """
    order: list[int] = []
    todo = [(list(range(len(texts))), known)]
    while todo:
        which, depth = todo.pop()
        if len(which) < 2:
            order.extend(which)
        elif depth >= known + shallow:
            order.extend(_blind(which, texts, depth))
        else:
            pivot = texts[which[len(which) // 2]][depth : depth + 1]
            less, equal, more = [], [], []
            for i in which:
                c = texts[i][depth : depth + 1]
                (equal if c == pivot else less if c < pivot else more).append(i)
            todo.append((more, depth))
            if pivot:
                todo.append((equal, depth + 1))
                todo.append((less, depth))
            else:  # ended, all equal; nothing is less
                order.extend(equal)
    shared = [0] * len(order)
    for k in range(1, len(order)):
        shared[k] = common(texts[order[k - 1]], texts[order[k]], known)
    return order, shared


def repeated_windows(contexts: list[tuple[int, bytes]], copies: list[int], p: Repeats) -> list[list[tuple[int, int]]]:
    """Of each distinct context the repeated windows, as ranges (first, last) of window starts.

    A context is the place of the anchor in it and its bytes.
    """
    m = len(contexts)
    out: list[list[tuple[int, int]]] = [[(0, len(c) - p.length)] if n > 1 else [] for (_, c), n in zip(contexts, copies)]
    if m == 1:
        return out
    right = [c[a:] for a, c in contexts]
    left = [c[:a][::-1] for a, c in contexts]
    if m == 2:
        agree = [(0, 1, common(left[0], left[1]), common(right[0], right[1], p.gram))]
    else:
        orders = deep_shallow(right, p.gram, p.shallow), deep_shallow(left, 0, p.shallow)
        if m > p.few:
            return _by_classes(contexts, copies, out, *orders, p)
        agree = []
        table = [[[0] * m for _ in range(m)] for _ in range(2)]
        for half, (order, shared) in zip(table, orders):
            for x in range(m):
                least = 1 << 30
                for y in range(x + 1, m):
                    least = min(least, shared[y])
                    half[order[x]][order[y]] = half[order[y]][order[x]] = least
        agree = [(i, j, table[1][i][j], table[0][i][j]) for i in range(m) for j in range(i)]
    for i, j, on_left, on_right in agree:
        if on_left + on_right >= p.length:
            for k in (i, j):
                a, c = contexts[k]
                first, last = max(0, a - on_left), min(len(c) - p.length, a + on_right - p.length)
                if first <= last:
                    out[k].append((first, last))
    return out


def _by_classes(contexts, copies, out, rights, lefts, p: Repeats):
    """For many contexts: for each reach to the left, classes of equal windows from both orders."""
    m = len(contexts)
    a = np.array([x for x, _ in contexts])
    last = np.array([len(c) for _, c in contexts]) - p.length
    n = np.array(copies)
    orders = [(np.array(order), np.array(shared)) for order, shared in (rights, lefts)]
    flags: list[tuple[int, np.ndarray]] = []
    for reach in range(int(a.max()) + 1):
        classes = []
        for (order, shared), depth in zip(orders, (p.length - reach, reach)):
            own = np.empty(m, np.int64)
            own[order] = np.cumsum(shared < depth) if depth else np.zeros(m, np.int64)
            classes.append(own)
        valid = np.flatnonzero((a >= reach) & (a - reach <= last))
        if not valid.size:
            continue
        _, which = np.unique(classes[0][valid] * (m + 1) + classes[1][valid], return_inverse=True)
        many = np.bincount(which, weights=n[valid])[which] > 1.5
        flags.append((reach, valid[many]))
    for reach, hit in flags:
        for i in hit.tolist():
            out[i].append((int(a[i]) - reach, int(a[i]) - reach))
    return out


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open ranges joined where they meet, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def group_keys(h: int, a: int, context: bytes, p: Repeats) -> list[int]:
    """The groups of a hot anchor's context, one per step that it has bytes enough for."""
    beside = p.length - p.gram
    left, right = context[:a], context[a + p.gram :]
    out = []
    for k in range(p.parts):
        on_left, on_right = k * beside // p.parts, beside - (k + 1) * beside // p.parts
        if len(left) >= on_left and len(right) >= on_right:
            key = b"%d|%d|" % (h, k) + left[len(left) - on_left :] + b"|" + right[:on_right]
            out.append(int.from_bytes(xxhash.xxh3_64_digest(key), "little", signed=True))
    return out


def _parted(p: Repeats, hot: Broadcast):
    """Contexts with the group they are compared in: their anchor's, or a hot anchor's parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4096):
            rows: list[int] = []
            groups: list[int] = []
            is_hot = np.isin(batch.column(0).to_numpy(), hot.value)
            for i in np.flatnonzero(is_hot).tolist():
                own = group_keys(*(batch.column(k)[i].as_py() for k in range(3)), p)
                rows += [i] * len(own)
                groups += own
            plain = np.flatnonzero(~is_hot)
            at = np.concatenate([plain, np.array(rows, np.int64)])
            key = np.concatenate([batch.column(0).to_numpy()[plain], np.array(groups, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.take(pa.array(at)).columns], names=["g", *batch.schema.names])

    return run


def _compare(p: Repeats):
    """From rows sorted by group, the repeated windows of its contexts. Holds each of them once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        group, anchor, count = None, None, {}

        def close() -> None:
            if sum(count.values()) < 2:
                return
            contexts = list(count)
            for (a, c), windows in zip(contexts, repeated_windows(contexts, list(count.values()), p)):
                for first, end in merged([(x, y + p.length) for x, y in windows]):
                    rows.append((*_digest(anchor, a, c), first, end))

        for batch in batches:
            for g, h, a, c, n in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (g, h) != (group, anchor):
                    close()
                    group, anchor, count = g, h, {}
                count[a, c] = count.get((a, c), 0) + n
            if len(rows) >= 20_000:
                yield _ranges(rows)
                rows.clear()
        close()
        yield _ranges(rows)

    return run


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["x1", "x2", "first", "end"])


def _cut(batches: Iterator[pa.RecordBatch], as_text: bool = False, clean: Broadcast | None = None) -> Iterator[pa.RecordBatch]:
    """Texts without their ranges; with the filter ``clean``, whole texts that do not pass it."""
    if clean is not None:
        batches = (b.filter(pa.array(~passing(clean.value, b.column(b.schema.get_field_index("bit")).to_numpy()))) for b in batches)
    for batch in sliced(batches):
        texts = as_bytes(batch.column(batch.schema.get_field_index("text")))
        found = batch.column(batch.schema.get_field_index("ranges")).to_pylist() if clean is None else [None] * batch.num_rows
        own = batch.column(batch.schema.get_field_index("own"))
        spans, kept = [], []
        for text, ranges in zip(texts, found):
            cut = merged([(x["start"], x["end"]) for x in ranges or []])
            at, parts = 0, []
            for a, b in cut:
                parts.append(text[at:a])
                at = b
            parts.append(text[at:])
            spans.append([{"start": a, "end": b} for a, b in cut])
            kept.append(b"".join(parts).decode("utf-8", "ignore") if as_text else b"".join(parts))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [own, pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, span), pa.array(kept, pa.string() if as_text else pa.binary())],
            names=["own", "n_bytes", "spans", "kept"],
        )


def without_repeats(docs: DataFrame, p: Repeats = Repeats(), text_col: str = "text", as_text: bool = False) -> DataFrame:
    """Per row of ``docs``: its other columns as the struct ``own``, n_bytes, spans, kept.

    ``kept`` is binary, or with ``as_text`` a string without the broken characters at cuts.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != text_col.lower()]
    spare = "none"  # a struct needs a field
    while spare in {c.lower() for c in docs.columns}:
        spare += "_"
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.struct(*others, F.lit(0).alias(spare)).alias("own"), text.alias("text"))
    keyed = base.select(
        F.xxhash64("own", "text").alias("k1"), F.xxhash64("text", "own", F.lit(1)).alias("k2"), "text", "own"
    )
    found = keyed.select("k1", "k2", "text").mapInArrow(releasing(_find_anchors(p)), "h long, k1 long, k2 long, lo long, a short, w short")
    places = written(
        found.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(_repeated_anchors, found.schema),
        "repeat-anchors",
    )
    # Equal rows have equal anchors: a set holds each once. As tables, lists and ranges join by a
    # shuffle of their own, so a row that repeats very often can be split over tasks.
    lists = written(places.groupBy("k1", "k2").agg(F.collect_set(F.struct("h", "lo", "a", "w")).alias("places")), "repeat-places")
    # Documents without a repeated anchor, most of them, are done; a filter spares their shuffle.
    wanted = spark.sparkContext.broadcast(row_filter(places, "k1"))
    near = let_pass(keyed, wanted, "k1")
    hit = near.join(lists, ["k1", "k2"]).select("k1", "k2", "text", "places")
    both = written(hit.mapInArrow(releasing(_contexts(p)), CONTEXTS), "repeat-contexts")
    contexts = both.where("context is not null").select("h", "a", "context", "copies")
    counted = contexts.groupBy("h").count().where(F.col("count") > p.hot).orderBy(F.desc("count"), "h").limit(p.most_hot)
    hot = spark.sparkContext.broadcast(np.array([r.h for r in counted.select("h").collect()], np.int64))
    windows = (
        contexts.mapInArrow(_parted(p, hot), "g long, h long, a int, context binary, copies long")
        .repartition(parts, "g").sortWithinPartitions("g", "h")
        .mapInArrow(releasing(_compare(p)), "x1 long, x2 long, first long, end long")
    )
    where = both.where("lo is not null").select("k1", "k2", "lo", "x1", "x2")
    ranges = written(
        where.join(windows, ["x1", "x2"])
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct((F.col("lo") + F.col("first")).alias("start"), (F.col("lo") + F.col("end")).alias("end"))).alias("ranges")),
        "repeat-ranges",
    )
    own = keyed.schema["own"].dataType.simpleString()
    schema = f"own {own}, n_bytes long, spans array<struct<start: long, end: long>>, kept {'string' if as_text else 'binary'}"
    cut = near.join(ranges, ["k1", "k2"], "left").select("own", "text", "ranges").mapInArrow(releasing(partial(_cut, as_text=as_text)), schema)
    clean = keyed.select("own", "text", filter_bit("k1").alias("bit")).mapInArrow(releasing(partial(_cut, as_text=as_text, clean=wanted)), schema)
    return cut.unionByName(clean)

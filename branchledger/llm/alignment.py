"""Alignment of two tokenizers' tokens of the same bytes.

Each text, with a space before it, is encoded by a byte-level vocabulary (A) and by one of pieces
(B). Per batch, ``merge_asof`` keyed by document finds for each token's start the covering token of
the other side; both directions together are all overlaps, and equal ends cut a document into groups.

How many documents link a pair of ids is counted over the whole corpus. Documents are held in
*blocks* of neighbouring ones, and within a block a pair is one row, however many of its documents
or tokens link it; so the count's shuffle combines map-side, and the join that brings counts back
has a pair at most once a block: no pair is hot. A document keeps its links as places in its
block's list. The highest count of an A id, one row per entry of A's vocabulary, is broadcast.

Defined cases: texts that are null or empty, or whose tokens of either side do not give back the bytes,
have no tokens: zeros, and an empty string for the digest; strings of special tokens in texts are
plain text; a text of any length is encoded and aligned whole, as a block of its own if it is long;
repeated rows, and rows with a null id, count as documents of their own; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchledger.llm.common import releasing, written
from branchledger.llm.packing import Tokens

#: A word with the spaces before it, or spaces that end a text: no piece spans two of these.
_UNIT = re.compile(r" *[^ ]+| +")
_MARK = "▁"


class Pieces:
    """Ids of texts with a space before them, by the sentencepiece library and a vocabulary of pieces.

    Words met before come from memory: up to ``most``, and as many older ones that come back as they
    are met again. A word whose pieces do not give back its bytes is remembered as broken.
    """

    def __init__(self, path: str, most: int = 300_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        if any(re.search(f"[^{_MARK}]{_MARK}", name) for name in names):
            raise ValueError(f"{path}: pieces that span words")
        self.bytes = [self._bytes(i, name) for i, name in enumerate(names)]
        self.size = np.array([len(b) for b in self.bytes])
        self.space = self.model.piece_to_id(_MARK)
        self.most, self.known, self.old, self.broken = most, {}, {}, set()

    def _bytes(self, i: int, name: str) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(name[3:-1], 16)])
        return name.replace(_MARK, " ").encode()

    def _learn(self, units: list[str]) -> None:
        # The library adds the space that every unit starts with; without anything else it adds none.
        for unit, ids in zip(units, self.model.encode([u[1:] for u in units], num_threads=1)):
            ids = ids if len(unit) > 1 else [self.space]
            self.known[unit] = array("I", ids).tobytes()
            if b"".join([self.bytes[i] for i in ids]) != unit.encode():
                self.broken.add(unit)

    def ids(self, texts: list[str]) -> Iterator[bytes | None]:
        """Of each text, which starts with a space, its ids; None where they do not give back its bytes."""
        units = [_UNIT.findall(t) for t in texts]
        if len(self.known) > self.most:
            self.old, self.known = self.known, {}
            self.broken = {u for u in self.broken if u in self.old}
        new = set().union(*units).difference(self.known)
        if new:
            again = {u for u in new if u in self.old}
            self.known.update((u, self.old[u]) for u in again)
            self._learn(list(new.difference(again)))
        find, broken = self.known.__getitem__, self.broken
        for own in units:
            yield None if broken and not broken.isdisjoint(own) else b"".join(map(find, own))
        for unit in new:  # long ones would fill the memory
            if len(unit) > 64:
                del self.known[unit]
                self.old.pop(unit, None)
                self.broken.discard(unit)


class Pair:
    """Both vocabularies, and what the digest writes for each token."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Tokens(path_a, literal=True), Pieces(path_b)
        n_a, n_b = self.a.size.size, self.b.size.size
        self.n_b, self.span = n_b, n_a * n_b
        # Token in A inside a group and at its end, token in B inside and at its end.
        text = [f"{i}{mark}" for mark, n in ((",", n_a), ("|", n_a), (",", n_b), (";", n_b)) for i in range(n)]
        self.written = np.array([t.encode() for t in text])
        self.width = np.array([len(t) for t in text])
        self.from_b = 2 * n_a

    def code(self, side_b: bool, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = self.n_b if side_b else self.from_b // 2
        return self.from_b * side_b + ids + n * ends


@lru_cache(maxsize=1)
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def tokens(texts: list[str], pair: Pair) -> tuple[list[bytes], list[bytes]]:
    """Ids of both sides, empty for texts without an alignment."""
    spaced = [f" {t}" if t else "" for t in texts]
    left, right = [], []
    for text, a, b in zip(spaced, pair.a.ids(spaced), pair.b.ids(spaced)):
        fine = text and b is not None and pair.a.size[np.frombuffer(a, "<u4")].sum() == len(text.encode())
        left.append(a if fine else b"")
        right.append(b if fine else b"")
    return left, right


def _frame(ids: list[bytes], size: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
    """Tokens of a batch: document, place among the batch's bytes where each starts; its end."""
    own = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
    counts = np.array([len(x) // 4 for x in ids])
    end = np.cumsum(size[own])  # documents stand one behind the other, equally long on both sides
    doc = np.repeat(np.arange(len(ids)), counts)
    return pd.DataFrame({"doc": doc, "start": end - size[own], "id": own}), end


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of tokens that overlap: doc, id_a, id_b. Both come in order of ``start``."""
    under_a = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    under_b = pd.merge_asof(b, a.assign(same=a["start"]), on="start", by="doc", suffixes=("_b", "_a"))
    # Tokens that start together are met in both directions.
    under_b = under_b[under_b["same"] != under_b["start"]]
    columns = ["doc", "id_a", "id_b"]
    return pd.concat([under_a[columns], under_b[columns]])


class Aligned:
    """What a batch of texts gives: numbers and digests of documents, their pairs and how often."""

    def __init__(self, texts: list[str], pair: Pair):
        left, right = tokens(texts, pair)
        a, end_a = _frame(left, pair.a.size)
        b, end_b = _frame(right, pair.b.size)
        n = len(texts)
        docs = np.arange(n)
        self.n_a, self.n_b = np.bincount(a["doc"], minlength=n), np.bincount(b["doc"], minlength=n)
        last_a, last_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        self.n_groups = np.bincount(a["doc"][last_a], minlength=n)
        self.digests = self._digests(a, b, last_a, last_b, pair)
        found = overlaps(a, b)
        self.n_links = np.bincount(found["doc"], minlength=n)
        key = found["doc"].to_numpy() * pair.span + found["id_a"].to_numpy() * pair.n_b + found["id_b"].to_numpy()
        key, self.times = np.unique(key, return_counts=True)
        self.doc, self.pair = np.divmod(key, pair.span)
        self.bounds = np.searchsorted(self.doc, np.append(docs, n))

    def _digests(self, a: pd.DataFrame, b: pd.DataFrame, last_a: np.ndarray, last_b: np.ndarray, pair: Pair) -> list[str]:
        group_a = np.cumsum(last_a) - last_a  # ends before this token
        group_b = np.cumsum(last_b) - last_b
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = pair.code(False, a["id"].to_numpy(), last_a)
        code[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = pair.code(True, b["id"].to_numpy(), last_b)
        text = pair.written[code].view(np.uint8)
        text = text[text > 0].tobytes()  # entries are filled up with zeros
        end = np.append(0, np.cumsum(pair.width[code]))[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [hashlib.sha256(text[x : y - 1]).hexdigest() if x < y else "" for x, y in zip(end[:-1], end[1:])]


DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary"
TABLE = f"block long, {DOCS}, place int, pair long, docs long"


def _blocks(path_a: str, path_b: str, block_bytes: int, batch_bytes: int):
    """Rows of documents, and per block rows of pairs with the number of its documents that link them."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                keys.append(key)
                texts.append(text)
                size += len(text) + 64
                if size >= batch_bytes:
                    yield keys, texts
                    keys, texts, size = [], [], 0
        if keys:
            yield keys, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(path_a, path_b)
        held: list[tuple[list, Aligned]] = []
        size = 0
        try:
            for keys, texts in batches_of(batches):
                held.append((keys, Aligned(texts, pair)))
                size += sum(map(len, texts))
                if size >= block_bytes:
                    yield from _block(held)
                    held, size = [], 0
            if held:
                yield from _block(held)
        finally:
            pair.a.old, pair.b.old = {}, {}  # the worker's next task goes on with the newer words

    return run


def _block(held: list[tuple[list, Aligned]]) -> Iterator[pa.RecordBatch]:
    block = uuid.uuid4().int >> 65
    schema = pa.schema(
        [("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
         ("places", pa.binary()), ("times", pa.binary()), ("place", pa.int32()), ("pair", pa.int64()), ("docs", pa.int64())]
    )
    pairs, docs = np.unique(np.concatenate([x.pair for _, x in held]), return_counts=True)
    for at in range(0, pairs.size, 1 << 16):
        own = pairs[at : at + (1 << 16)]
        columns = {"block": np.full(own.size, block), "place": np.arange(at, at + own.size, dtype=np.int32), "pair": own, "docs": docs[at : at + own.size]}
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(own.size, f.type) for f in schema], schema=schema)
    for keys, x in held:
        place = np.searchsorted(pairs, x.pair)
        # Steps from place to place within a document: small numbers, which Parquet packs well.
        step = np.diff(place, prepend=0)
        first = x.bounds[:-1][np.diff(x.bounds) > 0]
        step[first] = place[first]
        step, times, cuts = step.astype("<u4").tobytes(), x.times.astype("<u4").tobytes(), (4 * x.bounds).tolist()
        columns = {
            "block": np.full(len(keys), block), "doc_id": keys, "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups, "n_links": x.n_links, "groups_sha256": x.digests,
            "places": [step[u:v] for u, v in zip(cuts[:-1], cuts[1:])], "times": [times[u:v] for u, v in zip(cuts[:-1], cuts[1:])],
        }
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(keys), f.type) for f in schema], schema=schema)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a block's documents, from rows sorted by block with its pairs, in order, before them."""
    block, parts, count, top = None, [], None, None
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    for batch in batches:
        own, is_pair = batch.column("block").to_numpy(), ~np.asarray(batch.column("place").is_null())
        edge = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (is_pair[1:] != is_pair[:-1])))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), batch.num_rows]):
            part = batch.slice(a, b - a)
            if block != own[a]:
                block, parts, count, top = own[a], [], None, None
            if is_pair[a]:
                parts.append((part.column("count").to_numpy(), np.asarray(part.column("top"))))
                continue
            if count is None:
                count = np.concatenate([c for c, _ in parts]) if parts else np.zeros(0, np.int64)
                top = np.concatenate([t for _, t in parts]).astype(bool) if parts else np.zeros(0, bool)
                parts = []
            best, total = [], []
            for steps, times in zip(part.column("places").to_pylist(), part.column("times").to_pylist()):
                place, n = np.cumsum(np.frombuffer(steps, "<u4").astype(np.int64)), np.frombuffer(times, "<u4").astype(np.int64)
                best.append(int(n[top[place]].sum()))
                total.append(int((n * count[place]).sum()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(best, pa.int64()), pa.array(total, pa.int64())], names=[*names, "n_best", "count_sum"])


def aligned(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = 16 << 20, batch_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of each row of ``docs``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = written(rows.mapInArrow(releasing(_blocks(path_a, path_b, block_bytes, batch_bytes)), TABLE), "aligned")
    pairs = table.where("pair is not null").select("block", "place", "pair", "docs")
    counts = written(pairs.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.floor(F.col("pair") / _size_b(path_b))), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))  # a row per id of A at most
    scored = counts.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("top"))
    found = pairs.join(scored, "pair").select("block", "place", "count", "top")
    both = table.where("pair is null").drop("place", "pair", "docs").unionByName(found, allowMissingColumns=True)
    order = [F.asc("block"), F.asc_nulls_last("place")]
    return both.repartition(parts, "block").sortWithinPartitions(*order).mapInArrow(
        releasing(_counted), "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )


@lru_cache(maxsize=4)
def _size_b(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()

"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become pieces (id, place, length), never cut unless longer than a sequence. Each
partition packs its pieces, longest first, online and in bounded space: a fixed number of open
bins in a bitset keyed by free space; a piece goes to the open bin with the least space that
holds it, and when a bin too many is open, the fullest closes. Bins still open at the end are
packed again as pieces, of a sixteenth as many partitions, until one is left, which so sees at
most 16 times the fixed number of bins.

Tokenizers are used at their defaults: where a text spells an added token such as ``<|endoftext|>``,
that token's id stands for it. Such texts go through the library whole.

Defined cases: null text is empty, a document of the end id alone; a text of any length is
tokenised whole; equal lengths are placed in the order of id, piece and checksum; repeated rows
are packed as often as they occur; null ids pass; an empty table gives an empty result; columns
other than the named ones are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchledger.llm.common import releasing, written

#: White space that libraries disagree about; texts that hold any are tokenised in one go.
_UNSURE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: White space and the word after it: no token spans two of these.
_UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Of a longer run of white space, and of one at the end, more than the last may be one token.
_RUN = re.compile(r"[ \n][ \n](?:[ \n]|\Z)")


def _plain(text: str) -> bool:
    """Whether no token spans a cut before any space or line end of the text."""
    return not (any(c in text for c in "\t\v\f\r") or any(c in text for c in ("  ", " \n", "\n ", "\n\n")) and _RUN.search(text))


def _cut(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Plain texts cut before spaces and line ends: distinct parts, which of them come, each text's end there."""
    encoded = [t.encode() for t in texts]
    lengths = np.array([len(e) for e in encoded], np.int64)
    ends, joined = np.cumsum(lengths), b"".join(encoded)
    data = np.frombuffer(joined, np.uint8)
    starts = (data == 32) | (data == 10)
    starts[(ends - lengths)[lengths > 0]] = True
    at = np.flatnonzero(starts)
    parts = pa.Array.from_buffers(pa.large_string(), at.size, [None, pa.py_buffer(np.append(at, data.size)), pa.py_buffer(joined)])
    coded = parts.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(at, ends)


class Tokens:
    """Ids of texts as little-endian unsigned 32-bit integers, by the tokenizers library.

    The ids of a word with its leading white space do not depend on what stands around it, so
    those of words met before are kept. Beyond ``most`` words the older half is kept aside, of
    which words come back as they are met again. ``literal``: added tokens in a text are ordinary
    characters.
    """

    def __init__(self, path: str, most: int = 400_000, literal: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [] if literal else added
        self.most, self.known, self.old = most, {}, {}
        # Byte-level tokens are written with one character a byte.
        self.size = np.zeros(1 + max(self.tokenizer.get_vocab().values()), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.size[i] = 0 if token in added else len(token)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _encode_words(self, units: list[str], together: int = 512) -> list[bytes]:
        """Ids of words that begin with white space, many in one text, parted by their bytes."""
        groups = [units[a : a + together] for a in range(0, len(units), together)]
        out: list[bytes] = []
        for group, ids in zip(groups, self._encode(["".join(g) for g in groups])):
            until = np.cumsum(self.size[np.frombuffer(ids, "<u4")])
            ends = np.cumsum([len(u.encode()) for u in group])
            cut = np.minimum(np.searchsorted(until, ends), until.size - 1)
            if (until[cut] != ends).any():  # not a byte-level vocabulary
                out += self._encode(group)
                continue
            stops = ((cut + 1) * 4).tolist()
            out += [ids[a:b] for a, b in zip([0, *stops], stops)]
        return out

    def _learn(self, units: set[str]) -> None:
        """Ids of words met for the first time; a mark after a letter or digit has its own."""
        known, old = self.known, self.old
        marked = [u for u in units if u[-1] in ".,;:!?" and u[-2:-1].isalnum()]
        wanted = units.difference(marked)
        wanted.update([u[:-1] for u in marked], {u[-1] for u in marked})
        wanted = set(filterfalse(known.__contains__, wanted))
        if old:
            again = [u for u in wanted if u in old]
            known.update((u, old[u]) for u in again)
            wanted.difference_update(again)
        spaced = [u for u in wanted if u[0] in " \t\n\x0b\x0c\r" and not u.isspace()]
        known.update(zip(spaced, self._encode_words(spaced)))
        if len(spaced) < len(wanted):
            other = list(wanted.difference(spaced))
            known.update(zip(other, self._encode(other)))
        for u in marked:
            known[u] = known[u[:-1]] + known[u[-1]]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """In order; texts of about a batch share one call of the library."""
        if len(self.known) > self.most:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        whole = [bool(_UNSURE.search(t) or any(a in t for a in self.added)) for t in texts]
        plain = [not w and _plain(t) for t, w in zip(texts, whole)]
        own, which, ends = _cut([t for t, p in zip(texts, plain) if p])
        units = [None if p or w else _UNIT.findall(t) for t, p, w in zip(texts, plain, whole)]
        missing = set(filterfalse(known.__contains__, chain(own, *filter(None, units))))
        if missing:
            again = [u for u in missing if u in old]
            known.update((u, old[u]) for u in again)
            self._learn(missing.difference(again))
        find = known.__getitem__
        ids = list(map(find, own))
        sizes = np.array([len(x) for x in ids], np.int64) // 4
        n = sizes[which]
        until = np.append(0, np.cumsum(n))
        at = np.repeat((np.cumsum(sizes) - sizes)[which] - until[:-1], n) + np.arange(until[-1])
        tokens, begin, stops = np.frombuffer(b"".join(ids), "<u4")[at], 0, iter(until[ends].tolist())
        for text, p, parts in zip(texts, plain, units):
            if p:
                end = next(stops)
                yield tokens[begin:end].tobytes()
                begin = end
            else:
                yield self._encode([text])[0] if parts is None else b"".join(map(find, parts))
        for u in missing:  # long ones would fill the memory
            if len(u) > 64:
                self.known.pop(u, None)
                self.known.pop(u[:-1], None)


@lru_cache(maxsize=1)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def piece_table(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of tokenised documents: id, piece, start, length, ids_crc32.

    A document longer than ``length`` is cut into pieces of just that length, but for the first.
    """
    end = np.array([end_id], "<u4").tobytes()

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and size < 1 << 20:
                size += len(texts[stop])
                stop += 1
            for key, ids in zip(keys[at:stop], _tokens(tokenizer_path).ids(texts[at:stop])):
                ids += end
                n, start = len(ids) // 4, 0
                first = n % length or length
                for piece, until in enumerate(range(first, n + 1, length)):
                    yield key, piece, start, until - start, zlib.crc32(ids[4 * start : 4 * until])
                    start = until
            at = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        try:
            for batch in batches:
                columns = list(zip(*rows(batch))) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "piece", "start", "length", "ids_crc32"])
        finally:
            _tokens(tokenizer_path).old = {}  # the worker's next task goes on with the newer words

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        releasing(run), "id long, piece int, start long, length long, ids_crc32 long"
    )


class OpenBins:
    """A fixed number of open bins, found by free space in a bitset."""

    def __init__(self, capacity: int, most: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, most, first
        self.bits, self.open = 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, at_least: int) -> tuple[int, int] | None:
        """The open bin with the least free space of that much, out of the bitset."""
        above = self.bits >> at_least
        if not above:
            return None
        space = at_least + (above & -above).bit_length() - 1
        own = self.by_space[space]
        found = own.pop()
        if not own:
            self.bits &= ~(1 << space)
        self.open -= 1
        return found, space

    def place(self, size: int) -> tuple[int, int]:
        """The bin of a piece and its place there."""
        found = self._take(size)
        if found is None:
            found = (self.next, self.capacity)
            self.next += 1
        bin_, space = found
        left = space - size
        if left:
            self.by_space[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.most:
                self._take(1)  # the fullest
        return bin_, self.capacity - space

    def remaining(self) -> list[tuple[int, int]]:
        """The bins still open, and how full each is."""
        return [(b, self.capacity - space) for space, own in enumerate(self.by_space) for b in own]


def _pack(level: int, capacity: int, most: int):
    """Rows (length first) in the order they come, with bin and place; then open bins, marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, most, (level << 56) | (TaskContext.get().partitionId() << 28))
        names = None
        for batch in batches:
            names, schema = [*batch.schema.names, "bin", "offset", "open"], batch.schema
            placed = [bins.place(n) for n in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64()), pa.array([False] * len(placed), pa.bool_())],
                names=names,
            )
        if names and (left := bins.remaining()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for _, n in left], pa.int64()), *(pa.nulls(len(left), f.type) for f in list(schema)[1:]), pa.array([b for b, _ in left], pa.int64()), pa.nulls(len(left), pa.int64()), pa.array([True] * len(left), pa.bool_())],
                names=names,
            )

    return run


def pack(pieces: DataFrame, capacity: int = 2048, open_bins: int = 1024) -> DataFrame:
    """``pieces`` (a long column ``length`` up to ``capacity``, others) with sequence_id, offset."""
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c != "length"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def level(rows: DataFrame, k: int, n: int) -> DataFrame:
        order = [F.desc("length"), *(F.col(c) for c in rows.columns if c != "length")]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        packed = rows.repartition(n).sortWithinPartitions(*order).mapInArrow(_pack(k, capacity, open_bins), f"{schema}, bin long, offset long, open boolean")
        return written(packed, f"packed-{k}")

    first = level(pieces.select("length", *names), 0, parts)
    steps, now, k = [], first, 0
    while parts > 1:
        parts, k = -(-parts // 16), k + 1
        now = level(now.where("open").select("length", F.col("bin").alias("inner")), k, parts)
        steps.append(now.where("not open").select("inner", F.col("bin").alias("outer"), F.col("offset").alias("more")))
    rows = first.where("not open")
    for step in steps:
        rows = rows.join(step, rows.bin == step.inner, "left").select(
            "length", *names, F.coalesce("outer", "bin").alias("bin"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset")
        )
    return rows.select(*names, "length", F.col("bin").alias("sequence_id"), "offset")


def packed(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 0, open_bins: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise ``docs`` and pack them: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(piece_table(docs, tokenizer_path, length, end_id, id_col, text_col), "pieces")
    return pack(pieces, length, open_bins).select("id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

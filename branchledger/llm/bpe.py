"""Byte-level BPE: encoding with the tiktoken library and a local rank file, raw-byte decoding.

Long texts are encoded in pieces, cut only where the pattern must have a boundary: between a
character that is no white space and a space, which no match can span. A text that is long without
such a place is matched by the pattern one word at a time, and a match that is itself long (a run of
spaces, letters or marks) is encoded in parts: what the library gives for a part is kept up to
``ahead`` bytes before its end, where no later byte can change a token, and the next part starts there.
Ids come out as binary columns of little-endian unsigned 32-bit integers, so nothing is boxed on the way.

Defined cases: null text counts as empty and has no ids; every other text, however long, is
encoded whole; special tokens are ordinary text; repeated rows give repeated results; an empty
table gives an empty result; other columns pass unchanged, but for one that has the output's name,
which is replaced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

#: A space after a character that no reading of white space includes.
SAFE = re.compile(r"(?<=\S)(?= )")


@lru_cache(maxsize=2)
def encoding(rank_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a local rank file (base64 token and rank a line); held once a worker."""
    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, most: int) -> Iterator[str]:
    """``text`` in pieces of about ``most`` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > most:
        cut = SAFE.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


@lru_cache(maxsize=2)
def _ahead(enc: tiktoken.Encoding) -> int:
    """Bytes that suffice to know a token: the longest chain of merges, as for any merge list.

    A token's merge is that of the two parts its bytes come to by the ranks below its own.
    """
    tokens = sorted(((t, enc.encode_single_token(t)) for t in enc.token_byte_values()), key=lambda x: x[1])
    by_rank = {rank: token for token, rank in tokens}
    table: dict[tuple[bytes, bytes], int] = {}
    first: dict[bytes, bytes] = {}  # the left part of a token
    reach: dict[bytes, int] = {}
    longest = 0
    for token, rank in tokens:
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranked = [table.get(pair, rank) for pair in zip(parts, parts[1:])]
            best = min(ranked)
            if best == rank:
                raise ValueError(f"rank {rank} is no merge of two tokens")
            i = ranked.index(best)
            parts[i : i + 2] = [by_rank[best]]
        left, right = parts
        table[left, right], first[token] = rank, left
        behind, grown = 0, right
        while grown is not None:
            behind = max(behind, reach.get(grown, 0))
            grown = first.get(grown)
        reach[left] = max(reach.get(left, 0), len(left) + behind)
        longest = max(longest, reach[left])
    return longest


def _match_ids(match: str, enc: tiktoken.Encoding) -> Iterator[int]:
    """Ids of one long match of the pattern, part by part."""
    data, at, ahead = match.encode(), 0, _ahead(enc)
    size = 4 * ahead
    while len(data) - at > size:
        # A part may end inside a character: the library takes bytes of a single match, too.
        tokens = enc._encode_single_piece(data[at : at + size])
        used = 0
        for token in tokens:
            n = len(enc.decode_single_token_bytes(token))
            if used + n > size - ahead:
                break
            used += n
            yield token
        at += used
    yield from enc._encode_single_piece(data[at:])


def _long_ids(text: str, enc: tiktoken.Encoding, most: int) -> Iterator[int]:
    for match in regex.finditer(enc._pat_str, text):
        if len(match.group()) > most:
            yield from _match_ids(match.group(), enc)
        else:
            yield from enc.encode_ordinary(match.group())


def encode_text(text: str, enc: tiktoken.Encoding, most: int = 1 << 16) -> bytes:
    """Ids of a whole text. Matches longer than a sixteenth of ``most`` are encoded in parts."""
    out = []
    for piece in pieces(text, most):
        ids = enc.encode_ordinary(piece) if len(piece) <= 2 * most else array("I", _long_ids(piece, enc, max(1, most // 16)))
        out.append(np.array(ids, "<u4").tobytes())
    return b"".join(out)


def decode_ids(ids: bytes, enc: tiktoken.Encoding, most: int = 1 << 16) -> bytes:
    values = np.frombuffer(ids, "<u4")
    return b"".join(enc.decode_bytes(values[a : a + most].tolist()) for a in range(0, values.size, most))


def _mapped(df: DataFrame, source: str, target: str, convert) -> DataFrame:
    """``df`` with a binary column computed from another, batch by batch."""
    df = df.drop(target)
    i = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = 0, batch.num_rows
            while at < n:  # pieces of bounded size, as ids take more room than text
                size, stop, out = 0, at, []
                while stop < n and size < 32 << 20:
                    out.append(convert(batch.column(i)[stop].as_py()))
                    size += len(out[-1])
                    stop += 1
                part = batch.slice(at, stop - at)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, target])
                at = stop

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{own}, `{target}` binary")


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as little-endian unsigned 32-bit integers."""
    return _mapped(docs, text_col, ids_col, lambda text: encode_text(text or "", encoding(rank_path, pattern)))


def decode(docs: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids stand for, valid UTF-8 or not."""
    return _mapped(docs, ids_col, bytes_col, lambda ids: decode_ids(ids or b"", encoding(rank_path, pattern)))

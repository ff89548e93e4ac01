"""Quality rules by repetition coverage: characters inside repeated word n-grams and lines.

All counts are of the whole text and come from numpy: words are hashed by a polynomial, n-grams
by rolling combinations of word hashes, several lengths in one pass. A word belongs to the
coverage of a length if an n-gram around it equals an earlier one of the same text; the share of
characters so covered is compared with a limit for each length, as is that of repeated lines.

Defined cases: null text has no words and fails; empty text and white space likewise; a text of
any length is taken whole; each row is judged by itself, so repeated rows and ties need no rule;
ids may be null; an empty table gives an empty result; columns besides the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchledger.llm.common import as_bytes
from branchledger.llm.hashing import SPACES, chunks, mix, windows, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


@dataclass(frozen=True)
class Limits:
    """A text fails below ``least_words`` words or beyond any share."""

    least_words: int = 20
    #: Words in windows of ``window`` words that occur twice or more, in hundredths of all words.
    window: int = 8
    repeat_words: int = 30
    #: Characters inside repeated n-grams, first ones not counted, as a share of all, by length.
    covered: tuple[tuple[int, float], ...] = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))
    #: Characters in lines equal to an earlier line, as a share of all.
    line_chars: float = 0.20
    #: Symbols for each word.
    symbols: float = 0.5


def _repeats(run: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the n-grams that lie within a text: those found again, and those found before."""
    inside = np.flatnonzero(text[: run.size] == text[size - 1 :]) if run.size else np.zeros(0, np.int64)
    key = mix(run[inside] + text[inside].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later = np.zeros(inside.size, bool)
    later[order[1:]] = same
    any_ = later.copy()
    any_[order[:-1]] |= same
    return inside[any_], inside[later]


def _cover(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in n-grams that begin at ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step[:-1]) > 0


def measure(texts: list[bytes], limits: Limits) -> dict[str, np.ndarray]:
    """Counts of each text."""
    n = len(texts)
    hashed, text, start, end, data = words(texts)
    chars = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & ~SPACES[data])])
    size = chars[end] - chars[start]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])

    def by_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(text, weights=values, minlength=n).astype(np.int64)

    out = {"n_words": by_text(np.ones(hashed.size)), "word_chars": by_text(size), "n_symbols": symbols[begins[1:]] - symbols[begins[:-1]]}
    lengths = dict(limits.covered)
    for k in sorted({*lengths, limits.window}):
        twice, later = _repeats(windows(hashed, k), text, k)
        if k == limits.window:
            out["n_repeat_words"] = by_text(_cover(twice, k, hashed.size))
        if k in lengths:
            out[f"covered_{k}"] = by_text(size * _cover(later, k, hashed.size))
    lines, line_chars = [], []
    for t in texts:
        seen: set[bytes] = set()
        count = most = 0
        for line in t.split(b"\n"):
            if line in seen:
                count += 1
                most += len(b"".join(line.split()).decode("utf-8", "ignore"))
            elif line.strip():
                seen.add(line)
        lines.append(count)
        line_chars.append(most)
    return out | {"n_dup_lines": np.array(lines, np.int64), "dup_line_chars": np.array(line_chars, np.int64)}


def verdicts(m: dict[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Which texts fail the base rules, and which are kept."""
    failed = (m["n_words"] < limits.least_words) | (100 * m["n_repeat_words"] > limits.repeat_words * m["n_words"])
    kept = ~failed & (m["dup_line_chars"] <= limits.line_chars * m["word_chars"]) & (m["n_symbols"] <= limits.symbols * m["n_words"])
    for k, share in limits.covered:
        kept &= m[f"covered_{k}"] <= share * m["word_chars"]
    return failed, kept


def quality_rules(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, the counts, base_failed and kept. No shuffle."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    extra = ["dup_line_chars", *(f"covered_{k}" for k, _ in limits.covered)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(as_bytes(batch.column(1))):
                m = measure(part, limits)
                failed, kept = verdicts(m, limits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), *(pa.array(m[c], pa.int64()) for c in counts), pa.array(failed), pa.array(kept), *(pa.array(m[c], pa.int64()) for c in extra)],
                    names=[id_col, *counts, "base_failed", "kept", *extra],
                )

    longs = ", ".join(f"{c} long" for c in counts)
    more = ", ".join(f"{c} long" for c in extra)
    own = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {own}, {longs}, base_failed boolean, kept boolean, {more}")

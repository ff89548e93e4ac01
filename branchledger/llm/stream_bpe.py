"""BPE as a streaming transducer with bounded lookahead, and incremental decoding.

Encoding reads a text in pieces of any size and holds a bounded part of it:

1. added tokens are found in the raw text; what could yet become one is held back;
2. the rest is normalised (composed, white space to spaces, lower case) up to the last character
   that no later one can change;
3. words are split off at white space; a run without any is split by the pattern as it comes;
4. a word's bytes enter the merge transducer, which emits a token once no later byte can change it.

The *sufficient lookahead* follows from the merge list. What comes behind a position changes the
tokens before it only through a chain of merges of rising rank: one takes the last token that is not
yet touched as its left part, and its right part grew from the place where the one before took hold.
The longest such chain, weighted by the bytes of the left parts, is found in one pass over the list
(667 bytes for ``word_bpe_49k.json``). Tokens that end that far before the last byte read are
final, and what follows them is encoded as if it stood alone.

Decoding is a state machine, too: it takes ids in pieces and gives out text as soon as its bytes
are complete, or where the tokenizer has no decoder, token strings parted by spaces.

Defined cases: null text counts as empty and has no ids; every other text, however long, is encoded
whole; added tokens in a text become their ids; repeated rows give repeated results; an empty table
gives an empty result; other columns pass unchanged, but for one that has the output's name, which
is replaced; ids that the vocabulary lacks are left out of decoded text. A word of combining marks
only, which normalisation may reorder without end, is the one thing that is held whole.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import unicodedata
from pyspark.sql import DataFrame

from branchledger.llm.common import releasing

#: White space as the tokenizers' regular expressions know it.
_SPACE = r"\t-\r \x85\xa0  -     　"
_LAST_SPACE = regex.compile(f"[{_SPACE}]", regex.REVERSE)
_RUN = regex.compile(f"[^{_SPACE}]+")
_MORE = re.compile("[\x1c-\x1f]")
#: A character that later ones cannot change and that changes none before it.
_STARTER = regex.compile(r"[^\p{M}ᅠ-ᇿ]", regex.REVERSE)


#: Small numbers, each behind a space, as fixed-width text.
_NUMBERS = np.char.add(b" ", np.arange(1 << 16).astype("S"))


class Unsupported(ValueError):
    """A tokenizer file asks for something that the transducer does not do."""


def byte_glyphs() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it is printable."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


#: Above every entry of a table of merges.
_NONE = 1 << 62


_BYTE_OF = {glyph: byte for byte, glyph in enumerate(byte_glyphs())}


class Merges:
    """A merge list over token ids, and the lookahead that suffices for it."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        glyphs = byte_glyphs()
        self.inner = [vocab[g] for g in glyphs]
        self.last = [vocab[g + suffix] for g in glyphs]
        #: Pair of tokens, in one number, to the merge's rank (counted from one) and result, in one number.
        self.table: dict[int, int] = {}
        self.length: dict[int, int] = dict.fromkeys([*self.inner, *self.last], 1)
        made: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            # A token is made by one merge, after those of its parts: then a merge never enables an earlier one.
            if whole in made or a not in self.length or b not in self.length:
                raise Unsupported(f"merge {rank} makes a token twice or of parts not made yet")
            made[whole] = (a, b)
            self.length[whole] = self.length[a] + self.length[b]
            self.table[a << 32 | b] = rank + 1 << 32 | whole
        self.lookahead = self._sufficient(made)

    def _sufficient(self, made: dict[int, tuple[int, int]]) -> int:
        reach: dict[int, int] = {}  # longest chain whose last merge has this left part
        longest = 0
        for a, b in made.values():  # in order of rank
            behind, grown = 0, b
            while grown is not None:  # the tokens that the right part grew from
                behind = max(behind, reach.get(grown, 0))
                grown = made[grown][0] if grown in made else None
            reach[a] = max(reach.get(a, 0), self.length[a] + behind)
            longest = max(longest, reach[a])
        return longest

    def apply(self, symbols: list[int]) -> list[int]:
        """Merge ``symbols`` by rank, leftmost first."""
        return self._short(symbols) if len(symbols) <= 24 else self._long(symbols)

    def _short(self, symbols: list[int]) -> list[int]:
        own, find, none = [*symbols], self.table.get, _NONE
        ranked = [find(a << 32 | b, none) for a, b in zip(own, own[1:])]
        while ranked and (best := min(ranked)) < none:
            i = ranked.index(best)
            own[i : i + 2] = (whole,) = (best & 0xFFFFFFFF,)
            del ranked[i]
            if i < len(ranked):
                ranked[i] = find(whole << 32 | own[i + 1], none)
            if i:
                ranked[i - 1] = find(own[i - 1] << 32 | whole, none)
        return own

    def _long(self, symbols: list[int]) -> list[int]:
        own, n = [*symbols], len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        find = self.table.get
        queue = [(found, i) for i in range(n - 1) if (found := find(own[i] << 32 | own[i + 1]))]
        heapq.heapify(queue)
        while queue:
            best, i = heapq.heappop(queue)
            j = after[i] if own[i] >= 0 else -1
            if j < 0 or find(own[i] << 32 | own[j]) != best:
                continue
            whole = best & 0xFFFFFFFF
            own[i], own[j] = whole, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if found := find(whole << 32 | own[after[j]]):
                    heapq.heappush(queue, (found, i))
            if before[i] >= 0 and (found := find(own[before[i]] << 32 | whole)):
                heapq.heappush(queue, (found, before[i]))
        return [s for s in own if s >= 0]


class WordTransducer:
    """The bytes of one word in, its tokens out; holds ``block`` and twice the lookahead at most."""

    def __init__(self, merges: Merges, block: int = 4096):
        self.merges, self.block = merges, block
        self.held: list[int] = []  # symbols behind the last token given out
        self.byte: int | None = None  # the last byte: the word's end would mark it

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        inner, limit = self.merges.inner, self.block + 2 * self.merges.lookahead
        for a in range(0, len(data), self.block):
            piece = data[a : a + self.block]
            if self.byte is not None:
                self.held.append(inner[self.byte])
            self.held.extend(map(inner.__getitem__, piece[:-1]))
            self.byte = piece[-1]
            if len(self.held) > limit:
                tokens, at = self.merges.apply(self.held), 0
                final = len(self.held) - self.merges.lookahead
                for token in tokens:
                    if at + self.merges.length[token] > final:
                        break
                    at += self.merges.length[token]
                    out.append(token)
                self.held = self.held[at:]
        return out

    def finish(self) -> list[int]:
        symbols = self.held + ([] if self.byte is None else [self.merges.last[self.byte]])
        self.held, self.byte = [], None
        return self.merges.apply(symbols)


#: Fixed values of the file format: what the transducer does, as the tokenizer's file must ask for it.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SPLIT = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


class Vocabulary:
    """A tokenizer file of words with an end mark, and a bounded memory of words met before."""

    def __init__(self, path: str, most: int = 300_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] != _NORMALIZER or spec["pre_tokenizer"] != {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}:
            raise Unsupported(f"{path}: not a lower-casing BPE of words")
        if model["dropout"] or model["continuing_subword_prefix"] or model["ignore_merges"] or not model["end_of_word_suffix"]:
            raise Unsupported(f"{path}: options of the model")
        if spec["decoder"] not in (None, {"type": "ByteLevel"}) and spec["decoder"].get("type") != "ByteLevel":
            raise Unsupported(f"{path}: decoder {spec['decoder']}")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, model["end_of_word_suffix"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise Unsupported(f"{path}: added tokens that are not taken literally")
        self.tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.joined = spec["decoder"] is None
        every = _WORDS.replace("\\s", _SPACE)
        self.word, self.letters, self.marks = regex.compile(every), regex.compile(r"\p{L}+"), regex.compile(rf"[^{_SPACE}\p{{L}}\p{{N}}]+")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if self.added else None
        self.held_back = max(map(len, self.added), default=1) - 1
        self.most, self.known, self.old, self.words = most, {}, {}, {}
        # Texts of ids, for decoding: by place where the vocabulary has no gap to speak of.
        self.by_id = [self.tokens.get(i) for i in range(max(self.tokens) + 1)]

    def normalised(self, text: str) -> str:
        if not text.isascii():
            # The sigma of single letters, as no word's end is known yet.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()  # words hold no white space, so its runs may stay as they are

    def ids_of(self, runs: list[str]) -> bytes:
        """Ids of runs without white space; those met before come from memory."""
        if len(self.known) > self.most:
            self.old, self.known = self.known, {}
        known, long = self.known, []
        new = set(runs).difference(known)
        if new:
            again = {run for run in new if run in self.old}
            known.update((run, self.old[run]) for run in again)
            for run in new.difference(again):
                known[run] = b"".join(map(self._word, self.word.findall(run)))
                if len(run) > 64:
                    long.append(run)
        out = b"".join(map(known.__getitem__, runs))
        for run in long:
            del known[run]
        return out

    def _word(self, word: str) -> bytes:
        """Ids of a whole word, through the transducer once and then from memory."""
        found = self.words.get(word)
        if found is None:
            one = WordTransducer(self.merges)
            found = array("I", one.feed(word.encode()) + one.finish()).tobytes()
            if len(self.words) >= self.most:
                self.words.clear()
            if len(word) <= 64:
                self.words[word] = found
        return found

    @staticmethod
    def runs_of(text: str) -> list[str]:
        """Runs without white space, which no word leaves. Python's splits at more than these do."""
        return text.split() if not _MORE.search(text) else _RUN.findall(text)


class Encoder:
    """Text in pieces in, ids out, as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, run: int = 4096):
        self.v, self.run = vocabulary, run
        self.raw = self.plain = self.text = ""  # before added tokens are found; before normalising; normalised
        self.open: tuple[WordTransducer, regex.Pattern] | None = None  # a long word, and what continues it

    def feed(self, piece: str) -> Iterator[bytes]:
        self.raw += piece
        yield from self._scan(False)

    def finish(self) -> Iterator[bytes]:
        yield from self._scan(True)

    def _scan(self, final: bool) -> Iterator[bytes]:
        """Split at added tokens, which end whatever stands before them."""
        at = 0
        for m in self.v.special.finditer(self.raw) if self.v.special else ():
            self.plain += self.raw[at : m.start()]
            yield from self._normalise(True)
            yield array("I", [self.v.added[m.group()]]).tobytes()
            at = m.end()
        safe = len(self.raw) if final else max(at, len(self.raw) - self.v.held_back)
        self.plain += self.raw[at:safe]
        self.raw = self.raw[safe:]
        yield from self._normalise(final)

    def _normalise(self, final: bool) -> Iterator[bytes]:
        cut = len(self.plain)
        if not final:
            m = _STARTER.search(self.plain)
            cut = m.start() if m else 0
        self.text += self.v.normalised(self.plain[:cut])
        self.plain = self.plain[cut:]
        yield from self._split(final)

    def _split(self, final: bool) -> Iterator[bytes]:
        """Whole words of the normalised text; a long run without white space as it comes."""
        if self.open and self.text:
            one, more = self.open
            m = more.match(self.text)
            if m:
                yield array("I", one.feed(m.group().encode())).tobytes()
                self.text = self.text[m.end() :]
            if self.text:
                yield self._close()
        if final:
            yield from self._words(self.text)
            self.text = ""
            if self.open:
                yield self._close()
            return
        m = _LAST_SPACE.search(self.text)
        cut = m.start() if m else 0
        yield from self._words(self.text[:cut])
        self.text = self.text[cut:]
        if len(self.text) > self.run:
            yield from self._open_run()

    def _words(self, text: str) -> Iterator[bytes]:
        if own := self.v.runs_of(text):
            yield self.v.ids_of(own)

    def _open_run(self) -> Iterator[bytes]:
        """Words of a run without white space that later characters cannot change.

        Three characters are needed to know an ending such as ``'re``; a longer word that reaches
        the end stays open.
        """
        for m in self.v.word.finditer(self.text):
            if m.end() + 3 < len(self.text):
                yield self.v.ids_of([m.group()])
                continue
            cut = m.start()
            if m.end() - m.start() > 64:
                more = self.v.letters if self.v.letters.match(m.group()) else self.v.marks
                one = WordTransducer(self.v.merges)
                yield array("I", one.feed(m.group().encode())).tobytes()
                self.open, cut = (one, more), m.end()
            self.text = self.text[cut:]
            if self.open and self.text:
                yield self._close()
            return
        self.text = ""

    def _close(self) -> bytes:
        one, _ = self.open
        self.open = None
        return array("I", one.finish()).tobytes()


class Decoder:
    """Ids in pieces in, text out as soon as it is complete."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.started = vocabulary, False
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        if not self.v.joined:
            return self.bytes.decode(b"".join(self._raw(t) for t in self._known(ids)))
        try:
            text = " ".join(map(self.v.by_id.__getitem__, ids))
        except (IndexError, TypeError):  # ids that the vocabulary lacks
            text = " ".join(self._known(ids))
        if not text:
            return ""
        first, self.started = not self.started, True
        return text if first else " " + text

    def _known(self, ids: Iterable[int]) -> list[str]:
        return [t for t in map(self.v.tokens.get, ids) if t is not None]

    def _raw(self, token: str) -> bytes:
        found = [_BYTE_OF.get(g) for g in token]
        return token.encode() if None in found else bytes(found)

    def finish(self) -> str:
        return self.bytes.decode(b"", True)


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """Read once a worker."""
    return Vocabulary(path)


def encode_text(text: str, v: Vocabulary, piece: int = 1 << 15) -> bytes:
    encoder = Encoder(v)
    parts = [ids for a in range(0, len(text), piece) for ids in encoder.feed(text[a : a + piece])]
    return b"".join([*parts, *encoder.finish()])


def decode_ids(ids: bytes, v: Vocabulary, piece: int = 1 << 15) -> str:
    decoder, values = Decoder(v), np.frombuffer(ids, "<u4")
    parts = [decoder.feed(values[a : a + piece].tolist()) for a in range(0, values.size, piece)]
    return "".join([*parts, decoder.finish()])


def decimal(ids: bytes) -> bytes:
    """Ids as decimal numbers parted by spaces."""
    own = np.frombuffer(ids, "<u4")
    if not own.size or own.max() >= _NUMBERS.size:
        return " ".join(map(str, own.tolist())).encode()
    text = _NUMBERS[own].view(np.uint8)  # each filled up with zeros
    return text[text > 0].tobytes()[1:]


def mapped(df: DataFrame, source: str, **targets) -> DataFrame:
    """``df`` with columns made from another: name, and (Spark type, function); binary or string."""
    df = df.drop(*targets)
    i = df.columns.index(source)
    arrow = {"binary": pa.binary(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = 0, batch.num_rows
            while at < n:  # pieces of bounded size
                size, stop, out = 0, at, []
                while stop < n and size < 8 << 20:
                    value = batch.column(i)[stop].as_py()
                    out.append([convert(value) for _, convert in targets.values()])
                    size += sum(map(len, out[-1]))
                    stop += 1
                part = batch.slice(at, stop - at)
                made = [pa.array(column, arrow[kind]) for column, (kind, _) in zip(zip(*out), targets.values())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *targets])
                at = stop

    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInArrow(releasing(run), ", ".join([*own, *(f"`{name}` {kind}" for name, (kind, _) in targets.items())]))


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as little-endian unsigned 32-bit integers."""
    return mapped(docs, text_col, **{ids_col: ("binary", lambda text: encode_text(text or "", vocabulary(path)))})


def decode(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded", decimal_col: str | None = None) -> DataFrame:
    """``docs`` with the text that the ids stand for; null ids stand for none.

    ``decimal_col``: also a column of the ids as decimal numbers parted by spaces.
    """
    made = {text_col: ("string", lambda ids: decode_ids(ids or b"", vocabulary(path)))}
    if decimal_col:
        made[decimal_col] = ("binary", lambda ids: decimal(ids or b""))
    return mapped(docs, ids_col, **made)

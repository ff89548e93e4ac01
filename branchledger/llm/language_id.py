"""Language identification with string kernels.

The kernel of two texts is the mean, over n-gram lengths, of the number of character n-grams
present in both, divided by the geometric mean of their numbers (blended spectrum, presence).
A Nyström map on a fixed number of landmark blocks and one-versus-rest kernel ridge regression give
a value for each language. Texts are scored in batches: presence rows of a batch times the
landmarks' presence matrix is the kernel, times the coefficients the values, through a softmax
fitted on the learning sample the score. A text is taken in blocks of about ``block`` characters,
whose values are averaged by length: presence says little once a long text holds every n-gram.

Characters are folded into 64 symbols: none for what is no letter, one for each frequent letter of
the sample, a few shared by the rest; so an n-gram is a small number and presence is one write.

Learning takes at most ``sample`` texts of each language, chosen by a hash of the id, each at most
``longest`` characters; scoring reads every text whole and needs no shuffle.

Defined cases: null text and text without a letter are ``und`` with score 0; with nothing to learn
from, so is every text; equal values go to the language first in order; rows with equal texts get
equal results; null languages and null ids are not learned from; an empty table gives an empty
result; other columns pass unread, but for those that have an output's name, which are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kernel:
    lengths: tuple[int, ...] = (1, 2, 3)
    landmarks: int = 128
    ridge: float = 1e-3
    #: Texts of each language to learn from, at most, and their longest; languages, at most.
    sample: int = 400
    longest: int = 20_000
    #: Characters of a block, and blocks scored together.
    block: int = 1000
    batch: int = 64

    def blocks(self, text: str) -> list[str]:
        """The whole text in blocks of equal length."""
        n = max(1, round(len(text) / self.block))
        size = -(-len(text) // n) or 1
        return [text[a : a + size] for a in range(0, len(text) or 1, size)]


def letters(sample: list[str]) -> np.ndarray:
    """Symbol of each code point: 0 no letter, 1..55 the sample's frequent letters, 56..63 others."""
    table = np.zeros(0x110000, np.uint8)
    for block in range(0, 0x110000, 0x1000):
        for c in range(block, block + 0x1000):
            if chr(c).isalpha():
                table[c] = 56 + c % 8
    count = Counter(c for text in sample for c in text.lower() if c.isalpha())
    for i, (c, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0]))[:55]):
        table[ord(c)] = i + 1
    return table


def codes(texts: list[str], table: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of all texts as numbers below 64 ** n, and their texts' indices."""
    joined = "\n".join(t.lower() for t in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = table[points]
    lengths = np.array([len(t.lower()) + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), lengths)
    keep = np.ones(symbol.size, bool)
    keep[1:] = (symbol[1:] > 0) | (symbol[:-1] > 0)  # a run of other characters counts as one
    symbol, text = symbol[keep].astype(np.int64), text[keep]
    m = symbol.size - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(m, np.int64)
    for k in range(n):
        code = code * 64 + symbol[k : k + m]
    inside = (text[:m] == text[n - 1 :]) & (code > 0)
    return code[inside], text[:m][inside]


@dataclass
class Model:
    kernel: Kernel
    languages: list[str]
    table: np.ndarray | None = None
    #: By n-gram length: the landmarks' n-grams, and their presence (n-grams x landmarks), normalised.
    grams: list[np.ndarray] | None = None
    presence: list[np.ndarray] | None = None
    values: np.ndarray | None = None
    sharpness: float = 1.0

    def matrix(self, texts: list[str]) -> np.ndarray:
        """Kernel of texts with the landmarks, by one product for each n-gram length."""
        total = np.zeros((len(texts), self.presence[0].shape[1]), np.float32)
        for n, grams, landmarks in zip(self.kernel.lengths, self.grams, self.presence):
            flags = np.zeros((len(texts), 64**n), bool)
            code, text = codes(texts, self.table, n)
            flags[text, code] = True
            size = np.sqrt(np.maximum(1, flags.sum(axis=1)))
            total += flags[:, grams].astype(np.float32) @ landmarks / size[:, None].astype(np.float32)
        return total / len(self.kernel.lengths)

    def margins(self, texts: list[str]) -> np.ndarray:
        """Values of whole texts for each language: the mean over their blocks."""
        blocks = [(i, b) for i, text in enumerate(texts) for b in self.kernel.blocks(text)]
        total, weight = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for a in range(0, len(blocks), self.kernel.batch):
            part = blocks[a : a + self.kernel.batch]
            which, size = np.array([i for i, _ in part]), np.array([len(b) for _, b in part], float)
            np.add.at(total, which, self.matrix([b for _, b in part]) @ self.values * size[:, None])
            np.add.at(weight, which, size)
        return total / np.maximum(1, weight)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        languages, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if self.languages and t and any(c.isalpha() for c in t)]
        if known:
            share = softmax(self.margins([texts[i] for i in known]) * self.sharpness)
            for i, best, p in zip(known, share.argmax(axis=1).tolist(), share.max(axis=1).tolist()):
                languages[i], scores[i] = self.languages[best], min(1.0, p)
        return languages, scores


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str], k: Kernel) -> Model:
    """A model from a sample in a fixed order; landmarks are dealt over the languages."""
    names = sorted(set(languages))
    model = Model(k, names)
    if not names:
        return model
    model.table = letters(texts)
    turn: Counter = Counter()
    ranked = []
    for i, language in enumerate(languages):
        ranked.append((turn[language], language, i))
        turn[language] += 1
    chosen = [k.blocks(texts[i])[0] for _, _, i in sorted(ranked)[: k.landmarks]]
    model.grams, model.presence = [], []
    for n in k.lengths:
        flags = np.zeros((len(chosen), 64**n), bool)
        code, text = codes(chosen, model.table, n)
        flags[text, code] = True
        grams = np.flatnonzero(flags.any(axis=0))
        own = flags[:, grams].T.astype(np.float32)
        model.grams.append(grams)
        model.presence.append(own / np.sqrt(np.maximum(1, flags.sum(axis=1))).astype(np.float32))
    # Every block of the sample is a row to learn from.
    parts = [(i, b) for i, text in enumerate(texts) for b in k.blocks(text)]
    owner = np.array([i for i, _ in parts])
    rows = np.concatenate([model.matrix([b for _, b in parts[a : a + k.batch]]) for a in range(0, len(parts), k.batch)]).astype(float)
    square = np.concatenate([model.matrix(chosen[a : a + k.batch]) for a in range(0, len(chosen), k.batch)]).astype(float)
    value, vector = np.linalg.eigh((square + square.T) / 2)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])  # the Nyström map
    mapped = rows @ root
    language = np.array([names.index(x) for x in languages])
    target = np.where(language[owner][:, None] == np.arange(len(names)), 1.0, -1.0)
    # Languages weigh the same however many blocks they have.
    count = np.bincount(language[owner], minlength=len(names))
    weight = (owner.size / (len(names) * count))[language[owner]][:, None]
    ridge = np.linalg.solve(mapped.T @ (weight * mapped) + k.ridge * owner.size * np.eye(mapped.shape[1]), mapped.T @ (weight * target))
    model.values = root @ ridge
    margins = model.margins(texts)
    model.sharpness = min(
        (0.5 * 2**e for e in range(6)),
        key=lambda s: -np.log(np.maximum(1e-12, softmax(margins * s)[np.arange(language.size), language])).mean(),
    )
    return model


def train(docs: DataFrame, learn: Column, k: Kernel = Kernel(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the texts and languages of rows for which ``learn`` (over the id) holds."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).where(F.col("text").rlike(r"\p{L}") & (F.length("text") <= k.longest))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one a language
    if not counts:
        return fit([], [], k)
    size = F.element_at(F.create_map(*[F.lit(x) for pair in counts.items() for x in pair]), F.col("lang"))
    # A share of each language that leaves about twice its sample, then the first by hash.
    place = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) / F.lit(1 << 30)
    few = rows.where(place * size < 2 * k.sample).withColumn("place", place)
    taken: dict[str, list] = {}
    for r in few.select("lang", "place", "id", "text").orderBy("lang", "place", "id", "text").toLocalIterator():
        own = taken.setdefault(r.lang, [])
        if len(own) < k.sample:
            own.append((r.place, r.id, r.text))
    sample = [(language, text) for language, own in sorted(taken.items()) for _, _, text in own]
    return fit([t for _, t in sample], [x for x, _ in sample], k)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score."""
    docs = docs.drop(lang_col, score_col)
    i, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = [], []
            for a in range(0, batch.num_rows, 1024):
                found = shared.value.predict(batch.column(i).slice(a, 1024).to_pylist())
                languages += found[0]
                scores += found[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, lang_col, score_col])

    own = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema.fields)
    return docs.mapInArrow(run, f"{own}, `{lang_col}` string, `{score_col}` double")

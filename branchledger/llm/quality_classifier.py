"""Compression classifier for quality: Zstandard dictionaries of good and of bad text.

A text is compressed, block by block, once with a dictionary trained on texts labelled good and
once with one trained on texts labelled bad. The difference of the two sizes, normalised by their
sum and by the text's length, and the better one's size for each byte go through a logistic
calibration fitted on labelled texts that no dictionary has seen.

Learning takes a bounded sample: ``sample`` texts of each label of at most ``longest`` bytes, chosen
by a hash of the id; half train the dictionaries, half the calibration. Scoring reads every text
whole, needs no shuffle, and ships a model of fixed size.

Defined cases: null and empty text are one empty block and get the calibrated score of that; rows
with equal texts get equal scores; an id labelled both ways, or with null, is not learned from, and
neither are null ids; without texts of both labels to learn from, every score is the share of
good labels (0.5 if there are no labels); an empty table gives an empty result; other columns pass
unread, but for one that has the output's name, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchledger.llm.common import as_bytes, releasing


@dataclass(frozen=True)
class Fitting:
    #: Labelled texts of each class to learn from, at most, and their longest.
    sample: int = 2000
    longest: int = 32 << 10
    dictionary_bytes: int = 64 << 10
    level: int = 3
    block: int = 2048
    penalty: float = 1e-3


@dataclass
class Model:
    good: bytes
    bad: bytes
    prior: float
    block: int
    level: int
    low: list[float] = field(default_factory=list)
    high: list[float] = field(default_factory=list)
    mean: list[float] = field(default_factory=list)
    spread: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """A model with its compressors, made once in a task."""

    def __init__(self, model: Model):
        self.model, self.packers = model, []
        for data in (model.good, model.bad):
            if data:
                trained = zstandard.ZstdCompressionDict(data)
                trained.precompute_compress(level=model.level)
                self.packers.append(zstandard.ZstdCompressor(level=model.level, dict_data=trained, write_content_size=False))

    def features(self, texts: list[bytes]) -> np.ndarray:
        size, out = self.model.block, np.empty((len(texts), 3))
        for i, text in enumerate(texts):
            blocks = [text[a : a + size] for a in range(0, len(text) or 1, size)]
            good, bad = (sum(len(p.compress(b)) for b in blocks) for p in self.packers)
            n = max(1, len(text))
            out[i] = (bad - good) / (bad + good), (bad - good) / n, good / n
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        m = self.model
        if not m.weights or not texts:
            return np.full(len(texts), m.prior)
        x = (np.clip(self.features(texts), m.low, m.high) - m.mean) / m.spread
        return 1 / (1 + np.exp(-(x @ np.array(m.weights[:-1]) + m.weights[-1])))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Weights and intercept by Newton steps."""
    z, b = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        slope = weight * p * (1 - p) + 1e-9
        step = np.linalg.solve((z.T * slope) @ z + penalty * np.eye(b.size), z.T @ (weight * (y - p)) - penalty * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def train(docs: DataFrame, labels: DataFrame, learn: Column, f: Fitting = Fitting(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from the labelled rows for which ``learn`` (over the id) holds."""
    known = (
        labels.where(learn & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("top"), F.count(F.when(F.col(label_col).isNull(), 1)).alias("unknown"))
        .where("label = top and unknown = 0 and label in (0, 1)")
        .select("id", "label")
    )
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    # At most 4 * sample ids, a bound that does not grow with the table.
    order = F.xxhash64(F.col("id"), F.lit(20240601))
    chosen = known.where("label = 1").orderBy(order).limit(2 * f.sample).union(known.where("label = 0").orderBy(order).limit(2 * f.sample))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = (
        texts.join(F.broadcast(chosen), "id")
        .where(F.octet_length("text").between(1, f.longest))
        .groupBy("id", "label").agg(F.min("text").alias("text"))
    )
    taken = [
        [r.text.encode() for r in rows.where(F.col("label") == label).orderBy(order).limit(f.sample).collect()]
        for label in (1, 0)
    ]
    return fit(*taken, prior, f)


def fit(good: list[bytes], bad: list[bytes], prior: float, f: Fitting) -> Model:
    """A model from labelled texts: the first half for dictionaries, the rest to calibrate."""
    model = Model(b"", b"", prior, f.block, f.level)
    if min(len(good), len(bad)) < 16:
        return model
    try:
        model.good, model.bad = (
            zstandard.train_dictionary(f.dictionary_bytes, part[: len(part) // 2]).as_bytes() for part in (good, bad)
        )
    except zstandard.ZstdError:  # too little text for a trained dictionary: its text itself
        model.good, model.bad = (b"".join(part[: len(part) // 2])[-f.dictionary_bytes :] for part in (good, bad))
    good, bad = good[len(good) // 2 :], bad[len(bad) // 2 :]
    x = model.scorer().features(good + bad)
    y = np.array([1.0] * len(good) + [0.0] * len(bad))
    weight = np.where(y == 1, prior / len(good), (1 - prior) / len(bad)) * len(y)
    low, high = x.min(axis=0), x.max(axis=0)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-12
    model.low, model.high, model.mean, model.spread = low.tolist(), high.tolist(), mean.tolist(), spread.tolist()
    model.weights = _logistic((x - mean) / spread, y, weight, f.penalty).tolist()
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text, higher for better."""
    docs = docs.drop(score_col)
    spark, i = docs.sparkSession, docs.columns.index(text_col)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            found = scorer.scores([t or b"" for t in as_bytes(batch.column(i))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, score_col])

    own = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema.fields)
    return docs.mapInArrow(releasing(run), f"{own}, `{score_col}` double")

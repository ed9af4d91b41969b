"""A quality classifier: a generalised additive model with pairwise interactions.

Figures of each text are computed once, in one pass over the documents, and written. A bounded sample
of labelled rows (SAMPLE, in the order of a hash) is fitted on the driver: shallow trees are boosted on
one feature after another in turn, round after round, and add up to one table of values per feature;
then the pairs of features with the most left to explain get tables of their own in the same way.
Scoring every document is an addition of table entries by bin.

Only the text is an input. Defined cases: a null or empty text has all figures 0 and a score like any
other; labels that are null are skipped; a document with several labels counts once for each. Without
labels every score is 0.5. Null identifiers are never held out and never labelled. Repeated rows get
equal scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import landed, map_batches, read_table, record_batch
from tillwork.llm.hashing import words_in
from tillwork.llm.registry import query

#: At most so many labelled rows are fitted.
SAMPLE = 20_000

FEATURES = (
    "log_words", "word_length", "symbols", "digits", "upper", "stops", "marks", "bars", "lines",
    "other_bytes", "distinct", "top_word", "same_next", "same_lines", "ended_lines", "long_words",
)


def text_features(text: str | None) -> list[float]:
    data = (text or "").encode()
    words = words_in(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    some = lambda characters: float(byte[list(characters)].sum())
    counts = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    letters = float(byte[65:91].sum() + byte[97:123].sum() + byte[128:].sum()) or 1.0
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        some(b"#*$%&<>~^=+{}[]\\/") / n,
        float(byte[48:58].sum()) / len(data),
        float(byte[65:91].sum()) / letters,
        some(b".,;:") / n,
        some(b"!?") / n,
        some(b"|") / n,
        len(lines) / n,
        float(byte[128:].sum()) / len(data),
        len(counts) / n**0.8,
        counts.most_common(1)[0][1] / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines),
        sum(len(word) > 20 for word in words) / n,
    ]


@dataclass
class AdditiveModel:
    """Tables of values by bin, for features and for pairs of features."""

    bins: int = 32
    pair_bins: int = 8
    pairs: int = 6
    rounds: int = 80
    pair_rounds: int = 40
    rate: float = 0.15
    smooth: float = 5.0
    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pair_tables: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Labels 0 and 1; the same rows in the same order give the same model."""
        if len(y):
            inner = np.linspace(0, 1, self.bins + 1)[1:-1]
            self.edges = [np.unique(np.quantile(column, inner)) for column in x.T]
            positive = float(np.clip(y.mean(), 0.01, 0.99))
            self.base = float(np.log(positive / (1 - positive)))
        else:
            self.edges = [np.empty(0) for _ in FEATURES]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        if not len(y):
            return self
        binned = self._binned(x)
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for table, column in zip(self.tables, binned, strict=True):
                gradient, weight = self._slope(score, y)
                step = self._tree(*self._sums(column, gradient, weight, len(table)))
                table += step
                score += step[column]
        coarse = [column * self.pair_bins // len(t) for column, t in zip(binned, self.tables)]
        size = self.pair_bins
        for pair in self._best_pairs(coarse, *self._slope(score, y)):
            self.pair_tables[pair] = np.zeros(size * size)
        for _ in range(self.pair_rounds):
            for (i, j), table in self.pair_tables.items():
                cell = coarse[i] * size + coarse[j]
                gradient, weight = self._slope(score, y)
                step = self._cross(*self._sums(cell, gradient, weight, size * size))[0]
                table += step
                score += step[cell]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        total = np.full(len(x), self.base)
        for table, column in zip(self.tables, binned, strict=True):
            total += table[column]
        for (i, j), table in self.pair_tables.items():
            a = binned[i] * self.pair_bins // len(self.tables[i])
            b = binned[j] * self.pair_bins // len(self.tables[j])
            total += table[a * self.pair_bins + b]
        return 1 / (1 + np.exp(-total))

    def _binned(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, column, side="right") for e, column in zip(self.edges, x.T)]

    @staticmethod
    def _slope(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    @staticmethod
    def _sums(cell, gradient, weight, size) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(cell, gradient, size), np.bincount(cell, weight, size)

    def _gain(self, g, h):
        return g * g / (h + self.smooth)

    def _split(self, g: np.ndarray, h: np.ndarray) -> int:
        """Where to cut the bins in two; 0 for nowhere."""
        if len(g) < 2:
            return 0
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gains = self._gain(left_g, left_h) + self._gain(g.sum() - left_g, h.sum() - left_h)
        best = int(np.argmax(gains))
        return best + 1 if gains[best] > self._gain(g.sum(), h.sum()) + 1e-9 else 0

    def _tree(self, g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
        """A tree of that depth over the bins of one feature."""
        cut = self._split(g, h) if depth else 0
        if cut:
            return np.concatenate(
                [self._tree(g[:cut], h[:cut], depth - 1), self._tree(g[cut:], h[cut:], depth - 1)]
            )
        return np.full(len(g), self.rate * g.sum() / (h.sum() + self.smooth))

    def _cross(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        """The best cut of each feature of a pair at once: four values, and their gain."""
        size = self.pair_bins
        g, h = g.reshape(size, size), h.reshape(size, size)
        best, values = -1.0, np.zeros((size, size))
        sums = [np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (g, h)]
        for i in range(1, size):
            for j in range(1, size):
                parts = []
                for s in sums:
                    a, b, c, d = s[i, j], s[i, -1], s[-1, j], s[-1, -1]
                    parts.append(np.array([a, b - a, c - a, d - b - c + a]))
                gain = float(self._gain(*parts).sum())
                if gain > best:
                    best = gain
                    four = self.rate * parts[0] / (parts[1] + self.smooth)
                    values[:i, :j], values[:i, j:], values[i:, :j], values[i:, j:] = four
        return values.ravel(), best

    def _best_pairs(self, coarse, gradient, weight) -> list[tuple[int, int]]:
        size = self.pair_bins
        gains = {}
        for i, j in combinations(range(len(coarse)), 2):
            sums = self._sums(coarse[i] * size + coarse[j], gradient, weight, size * size)
            gains[i, j] = self._cross(*sums)[1]
        return sorted(gains, key=lambda pair: (-gains[pair], pair))[: self.pairs]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("figures", pa.list_(pa.float64()))])
    for batch in batches:
        figures = [text_features(t) for t in batch.column("text").to_pylist()]
        yield record_batch(schema, batch.column("doc_id"), figures)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and figures of every document, written: they serve both fitting and scoring."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return landed(map_batches(rows, _measure, "doc_id long, figures array<double>"), "figures")


def held_out(doc_id: str = "doc_id"):
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def fitted(figures: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """A model of ``labels`` (doc_id, quality), without the rows that are held out."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    rows = known.select("doc_id", "quality").join(figures, "doc_id")
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("quality")]
    some = rows.orderBy(*order).limit(sample).select("figures", "quality").toArrow()
    x = np.array(some.column("figures").to_pylist(), float).reshape(-1, len(FEATURES))
    return AdditiveModel().fit(x, np.array(some.column("quality").to_pylist(), float))


def scored(figures: DataFrame, model: AdditiveModel) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column("figures").flatten())
            yield record_batch(schema, batch.column("doc_id"), model.score(flat.reshape(-1, len(FEATURES))))

    return map_batches(figures, add, "doc_id long, score double")


@query()
def op9_quality_classifier(spark, sf_dir):
    """A score for every document, from a model of the labelled rows that are not held out."""
    figures = measured(read_table(spark, sf_dir, "documents"))
    model = fitted(figures, read_table(spark, sf_dir, "labels"))
    return scored(figures, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

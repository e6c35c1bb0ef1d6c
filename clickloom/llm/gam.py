"""Quality classifier: a generalised additive model with pairwise interactions over text statistics.

Every feature is cut into bins at quantiles of the training sample. Boosting goes through the features
in turn: each gets a shallow tree over its bins, fitted to the present residuals, and the tree's leaves
are added to the feature's lookup table. Then pairs of features are ranked by what a tree over both would
still explain, and the best ones get tables of two dimensions in the same way. A score is the sum of the
tables' entries for a text's bins, through the logistic function: vectorised additions.

The model is fitted on the driver from at most ``sample`` labelled rows (those of the smallest hashes),
of which it sees the features alone, some 15 numbers a row. All texts are scored whole, in tasks that hold
one Arrow batch; only the labelled sample's ids are broadcast.

Null text counts as empty and has a score like any other. Null labels and ids are left out; of several
labels of a document the lowest counts. Without labelled rows the score is 0.5; with one label only, it is
near that label. Equal texts have equal scores, whatever their ids, and extra columns play no part.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import map_arrow

#: Labelled rows the model is fitted on, at most.
SAMPLE = 20_000

FEATURES = (
    "log_words",
    "mean_word_length",
    "upper_share",
    "digit_share",
    "mark_share",
    "symbol_share",
    "space_share",
    "other_share",
    "distinct_words",
    "top_word",
    "same_as_before",
    "words_per_line",
    "distinct_lines",
    "words_ending_in_marks",
    "words_without_letters",
)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: 0 lower and other letters, 1 upper, 2 digit, 3 mark, 4 symbol, 5 space, 6 other."""
    kinds = {"Lu": 1, "Lt": 1, "Ll": 0, "Lo": 0, "Lm": 0, "Mn": 0, "Mc": 0, "Zs": 5, "Zl": 5, "Zp": 5}
    table = np.full(sys.maxunicode + 1, 6, np.uint8)
    for code in range(0x20000):
        kind = unicodedata.category(chr(code))
        table[code] = kinds.get(kind, {"N": 2, "P": 3, "S": 4}.get(kind[0], 6))
    table[[9, 10, 11, 12, 13]] = 5
    table[[ord(c) for c in "#*%&@\\_/"]] = 4  # rare as punctuation in prose
    return table


def features(text: str) -> list[float]:
    """The FEATURES of a text."""
    words = text.encode("utf-8", "surrogatepass").split()  # at ASCII white space
    n = len(words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _classes()[codes]
    chars = max(len(codes), 1)
    counts = np.bincount(kinds, minlength=7)
    letters = max(int(counts[0] + counts[1]), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    total = max(n, 1)
    ends = np.flatnonzero(kinds[1:] == 5)  # characters before white space
    ending = np.bincount(kinds[ends], minlength=7) if len(ends) else np.zeros(7)
    spaced = np.flatnonzero(np.concatenate([[True], kinds == 5, [True]]))
    letter_sums = np.concatenate([[0], np.cumsum(kinds < 2)])
    starts, stops = spaced[:-1], spaced[1:] - 1
    held = stops > starts
    bare = int((letter_sums[stops[held]] == letter_sums[starts[held]]).sum())
    counted = Counter(words)
    return [
        math.log1p(n),
        (chars - int(counts[5])) / total,
        int(counts[1]) / letters,
        int(counts[2]) / chars,
        int(counts[3]) / chars,
        int(counts[4]) / chars,
        int(counts[5]) / chars,
        int(counts[6]) / chars,
        len(counted) / total,
        max(counted.values(), default=0) / total,
        sum(map(eq, words, words[1:])) / total,
        n / max(len(lines), 1),
        len(set(lines)) / max(len(lines), 1),
        float(ending[3] + ending[4]) / total,
        bare / total,
    ]


class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, bins: int = 32, pair_bins: int = 12, pairs: int = 8, rounds: int = 120, rate: float = 0.15):
        self.bins, self.pair_bins, self.n_pairs, self.rounds, self.rate = bins, pair_bins, pairs, rounds, rate
        self.start = 0.0
        self.edges: list[np.ndarray] = []
        self.coarse: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        if not len(y):
            return self
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.start = math.log(share / (1 - share))
        if y.min() == y.max():
            return self
        self.edges = [_cuts(column, self.bins) for column in x.T]
        self.coarse = [_cuts(column, self.pair_bins) for column in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        binned = [np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)]
        logit = np.full(len(y), self.start)
        for _ in range(self.rounds):
            for table, places in zip(self.tables, binned):
                g, h = _gradients(logit, y, places, len(table))
                step = self.rate * _tree(g, h)
                table += step
                logit += step[places]
        rough = [np.searchsorted(e, c, side="right") for e, c in zip(self.coarse, x.T)]
        sizes = [len(e) + 1 for e in self.coarse]
        worth = []
        for i in range(len(sizes)):
            for j in range(i + 1, len(sizes)):
                g, h = _gradients(logit, y, rough[i] * sizes[j] + rough[j], sizes[i] * sizes[j])
                shape = sizes[i], sizes[j]
                fitted = _tree_of_two(g.reshape(shape), h.reshape(shape))
                worth.append((float((fitted * g.reshape(shape)).sum()), i, j))
        worth.sort(key=lambda w: (-w[0], w[1:]))
        self.pairs = [(i, j) for gain, i, j in worth[: self.n_pairs] if gain > 0]
        self.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in self.pairs]
        for _ in range(self.rounds // 2):
            for (i, j), table in zip(self.pairs, self.pair_tables):
                places = rough[i] * sizes[j] + rough[j]
                g, h = _gradients(logit, y, places, table.size)
                step = self.rate * _tree_of_two(g.reshape(table.shape), h.reshape(table.shape))
                table += step
                logit += step.ravel()[places]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        logit = np.full(len(x), self.start)
        for edges, table, column in zip(self.edges, self.tables, x.T):
            logit += table[np.searchsorted(edges, column, side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a = np.searchsorted(self.coarse[i], x[:, i], side="right")
            b = np.searchsorted(self.coarse[j], x[:, j], side="right")
            logit += table[a, b]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _gradients(logit: np.ndarray, y: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return np.bincount(places, y - p, size), np.bincount(places, p * (1 - p), size)


#: Keeps leaves of few rows small.
_PRIOR = 1.0


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Best first place of the right side, and its gain; 0 if no split gains."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + _PRIOR) + right_g**2 / (right_h + _PRIOR) - all_g**2 / (all_h + _PRIOR)
    if not len(gain) or gain.max() <= 1e-9:
        return 0, 0.0
    return int(gain.argmax()) + 1, float(gain.max())


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A tree over consecutive bins: the value of each bin."""
    at, _ = _split(g, h) if depth else (0, 0.0)
    if not at:
        return np.full(len(g), g.sum() / (h.sum() + _PRIOR))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _tree_of_two(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree that cuts one feature, then each side by the other: the value of each cell."""

    def cut(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        best, out = -1.0, None
        for at in range(1, a.shape[0]) or [0]:
            parts, gain = [], 0.0
            for part in (slice(0, at), slice(at, None)):
                pg, ph = a[part].sum(0), b[part].sum(0)
                if not a[part].shape[0]:
                    continue
                place, more = _split(pg, ph)
                gain += more + pg.sum() ** 2 / (ph.sum() + _PRIOR)
                parts.append((part, place, pg, ph))
            if gain > best:
                best, out = gain, parts
        values = np.zeros_like(a)
        for part, place, pg, ph in out or []:
            for side in (slice(0, place), slice(place, None)):
                if pg[side].size:
                    values[part, side] = pg[side].sum() / (ph[side].sum() + _PRIOR)
        return values

    one, other = cut(g, h), cut(g.T, h.T).T
    return one if (one * g).sum() >= (other * g).sum() else other


def _numbers(texts: pa.Array) -> np.ndarray:
    rows = [features(t.as_py() or "") for t in texts]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """A model from at most ``sample`` of the labelled documents."""
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("y"))
    chosen = marks.orderBy(F.xxhash64(key), key).limit(sample)
    rows = docs.select(F.col(key), F.col(text).alias("x")).join(F.broadcast(chosen), key).select(key, "y", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.array(_numbers(batch.column(2)).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), lists], names=["k", "y", "x"])

    kind = docs.schema[key].dataType.simpleString()
    found = map_arrow(rows, run, f"k {kind}, y int, x array<double>").orderBy(F.xxhash64("k"), "k", "x").limit(sample).toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(found.num_rows, len(FEATURES))
    return AdditiveModel().fit(x, (np.array(found.column("y").to_pylist(), float) > 0).astype(float))


def score(docs: DataFrame, model: AdditiveModel, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The columns ``keep`` and the score of every row's text."""
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_numbers(batch.column(batch.num_columns - 1)))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*keep, name])

    return map_arrow(docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text_")), run, schema)

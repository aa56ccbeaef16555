"""Quality by a generalised additive model with pairwise interactions.

Every feature of a text has a lookup table over bins, and some pairs of features have one over pairs of bins.  Shallow trees
fitted to the loss, one feature after the other in many small rounds, add up to the tables.  A score is the sum of the
tables' entries, through a logistic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stepstone.llm.labelled import labelled_sample, remainder
from stepstone.llm.registry import documents, query
from stepstone.llm.texts import flat_utf8, named, slices, unused, with_text
from stepstone.llm.toxicity import labels_of

#: Labelled rows that the model is fitted on, at most: bad ones and good ones.
SAMPLE = (20_000, 20_000)
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, LEAST_HESSIAN = 150, 60, 0.1, 2.0
GOOD_FROM = 0.3

#: Kinds of bytes that are counted, each as a share of a text's bytes.
KINDS = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#*$%&<>@^~=+_\\",
    "bars": b"|", "exclamations": b"!?", "stops": b".", "commas": b",;:", "lines": b"\n",
}
FEATURES = (
    "log_words", "word_bytes", "long_word", *KINDS, "other_bytes", "distinct_words", "repeats_next", "short_words",
    "distinct_lines", "capital_words", "stop_words", "common_word",
)


def features(texts: pa.Array) -> np.ndarray:
    """Row of ``FEATURES`` for each text; null and empty texts are zeros."""
    data, offsets = flat_utf8(texts)
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    at = {name: k for k, name in enumerate(FEATURES)}
    size = np.maximum(np.diff(offsets), 1)
    kind_of = np.zeros(256, np.int64)
    for k, letters in enumerate(KINDS.values()):
        kind_of[list(letters)] = k + 1
    kind_of[128:] = len(KINDS) + 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    width = len(KINDS) + 2
    shares = np.bincount(owner * width + kind_of[data], minlength=n * width).reshape(n, width) / size[:, None]
    out[:, at["capitals"] : at["capitals"] + len(KINDS) + 1] = shares[:, 1:]
    whole = data.tobytes()
    for k in range(n):
        text = whole[offsets[k] : offsets[k + 1]]
        words = text.split()
        count = len(words)
        if not count:
            continue
        lengths = np.fromiter(map(len, words), np.int64, count)
        distinct = set(words)
        lines = [x for x in text.split(b"\n") if x]
        row = out[k]
        row[at["log_words"]] = np.log1p(count)
        row[at["word_bytes"]] = lengths.mean()
        row[at["long_word"]] = np.log1p(lengths.max())
        row[at["distinct_words"]] = len(distinct) / count
        row[at["repeats_next"]] = sum(map(eq, words, words[1:])) / count
        row[at["short_words"]] = (lengths <= 3).mean()
        row[at["distinct_lines"]] = len(set(lines)) / max(len(lines), 1)
        row[at["capital_words"]] = sum(map(bytes.istitle, words)) / count
        row[at["stop_words"]] = sum(w.endswith((b".", b"?", b"!")) for w in words) / count
        row[at["common_word"]] = np.log1p(count / len(distinct))
    return out


@dataclass
class Model:
    """Borders of bins by feature, a table by feature and by pair, and the constant."""

    constant: float
    borders: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability to be good, by table lookups and additions."""
        total = np.full(len(rows), self.constant)
        for k, (borders, table) in enumerate(zip(self.borders, self.tables, strict=True)):
            total += table[np.searchsorted(borders, rows[:, k], "right")]
        for (a, b), table in self.pairs.items():
            total += table[np.searchsorted(self.coarse[a], rows[:, a], "right"), np.searchsorted(self.coarse[b], rows[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _borders(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _step(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return gradient / (hessian + 1.0)


def _gain(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    return np.where(hessian >= LEAST_HESSIAN, gradient**2 / (hessian + 1.0), -np.inf)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, bins on the left) of the best cut of a row of bins; no gain if none is allowed."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return -np.inf, 0
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - g.sum() ** 2 / (h.sum() + 1.0)
    best = int(gains.argmax())
    return float(gains[best]), best + 1


def tree_over_bins(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values by bin of a tree that cuts the bins into at most ``leaves`` runs, the best cut first."""
    runs = [(0, len(g))]
    while len(runs) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b]), k) for k, (a, b) in enumerate(runs)]
        gain, left, k = max(cuts)
        if not gain > 0:
            break
        a, b = runs[k]
        runs[k : k + 1] = [(a, a + left), (a + left, b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = _step(g[a:b].sum(), h[a:b].sum())
    return out


def tree_over_pairs(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of a tree over a grid of bins: one cut along the first feature, one along the second on each side."""
    best, values = 0.0, np.zeros(g.shape)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, gg.shape[0]):
            gain, made = -(gg.sum() ** 2) / (hh.sum() + 1.0), np.zeros(gg.shape)
            for side in (slice(0, cut), slice(cut, None)):
                along_g, along_h = gg[side].sum(axis=0), hh[side].sum(axis=0)
                more, left = _best_cut(along_g, along_h)
                gain += along_g.sum() ** 2 / (along_h.sum() + 1.0) + max(more, 0.0)
                spans = (slice(0, left), slice(left, None)) if more > 0 else (slice(None),)
                for span in spans:
                    made[side, span] = _step(along_g[span].sum(), along_h[span].sum())
            if gain > best:
                best, values = gain, made.T if flip else made
    return best, values


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boost one feature after the other, then the pairs that would gain most; without both classes the score is even."""
    if len(rows) == 0 or labels.min() == labels.max():
        return Model(0.0)
    n_features = rows.shape[1]
    share = labels.mean()
    model = Model(
        float(np.log(share / (1 - share))),
        [_borders(rows[:, k], BINS) for k in range(n_features)], [],
        [_borders(rows[:, k], PAIR_BINS) for k in range(n_features)],
    )
    bins = [np.searchsorted(b, rows[:, k], "right") for k, b in enumerate(model.borders)]
    model.tables = [np.zeros(len(b) + 1) for b in model.borders]
    total = np.full(len(rows), model.constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(n_features):
            g, h = slopes()
            size = len(model.tables[k])
            add = RATE * tree_over_bins(np.bincount(bins[k], g, size), np.bincount(bins[k], h, size))
            model.tables[k] += add
            total += add[bins[k]]

    coarse = [np.searchsorted(b, rows[:, k], "right") for k, b in enumerate(model.coarse)]
    width = [len(b) + 1 for b in model.coarse]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * width[b] + coarse[b], values, width[a] * width[b]).reshape(width[a], width[b])

    g, h = slopes()
    gains = {(a, b): tree_over_pairs(grid(a, b, g), grid(a, b, h))[0] for a, b in combinations(range(n_features), 2)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pairs = {(a, b): np.zeros((width[a], width[b])) for a, b in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            g, h = slopes()
            add = RATE * tree_over_pairs(grid(a, b, g), grid(a, b, h))[1]
            model.pairs[a, b] += add
            total += add[coarse[a], coarse[b]]
    return model


def fit_on(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Model:
    """Model of ``labels.quality`` from rows whose remainder by 5 is not 0; only features leave the tasks."""
    rows = labelled_sample(docs, labels, "quality", remainder("doc_id", 5) != 0, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = features(batch.column(1))
            values = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values, batch.column(2)], names=["doc_id", "x", "label"])

    found = rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, x array<double>, label int").orderBy("doc_id", "x").toArrow()
    x = found.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(x, found.column("label").to_numpy().astype(float))


def with_score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """Columns ``keep`` and the score, 0 to 1, of every row; null and empty texts have features of zero.

    ``name`` must not be one of ``keep``; any other names may be.
    """
    names = [*(f"c{k}" for k in range(len(keep))), "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = model.score(features(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=names)

    picked = with_text(docs, keep, text_col)
    return picked.mapInArrow(run, StructType([*picked.schema.fields[:-1], StructField("score", DoubleType())])).toDF(*keep, name)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, that score ``GOOD_FROM`` or more."""
    score = unused(docs.columns, "quality_score")
    scored = with_score(docs, fit_on(docs, labels), docs.columns, name=score)
    return scored.where(F.col(score) >= GOOD_FROM).select(*map(named, docs.columns))


@query("op9_additive_quality")
def additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = with_score(docs, fit_on(docs, labels_of(spark, sf_dir)), ["doc_id"])
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")
    )

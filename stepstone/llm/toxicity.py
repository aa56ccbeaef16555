"""Toxicity by subword bags: embeddings of character n-grams, averaged into a linear softmax.

A word is the mean of its n-grams' vectors, so a misspelling that was never seen shares most of them with the word it comes
from.  Vectors are averaged over windows of a text, as one insult in a long text must not drown; a word counts once in a
window, and a text scores as its worst window.  Embeddings and softmax are trained together in numpy, each text teaching by the window that is worst just then.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stepstone.llm.labelled import labelled_sample, remainder
from stepstone.llm.registry import documents, query
from stepstone.llm.texts import named, slices, spread_ranges, unused, with_text

#: Labelled rows that the model is fitted on, at most: clean ones and toxic ones.
SAMPLE = (3000, 1500)
#: n-gram sizes in bytes, with < and > around a word; buckets that they are hashed to; size of a vector.
SIZES, BUCKET_BITS, WIDTH = (3, 4, 5, 6), 20, 8
#: Words of a window at most; shorter windows weigh as if they had the least number.
WINDOW, LEAST_WINDOW = 32, 16
#: Steps over the sample; in the first ones a text is one window.  A step moves the parameter with the largest slope, of the
#: vectors, the softmax and the bias, by about its rate and others in proportion, so that rare n-grams aren't learned by heart.
STEPS, WHOLE_TEXT_STEPS, RATES = 80, 15, (6.0, 0.3, 0.3)
#: Words whose margins a task remembers before it forgets them all.
REMEMBERED = 1 << 20
#: n-grams that fewer texts show than this, counted once for each of their words, keep a vector of zeros.
LEAST_SEEN = 5
#: Share of the toxic texts in the loss; missed ones count more than false alarms.
TOXIC_WEIGHT = 0.75
TOXIC_FROM = 0.7


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of all n-grams of the words, and of each word as a whole."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    room = ends[owner] - np.arange(len(data))
    owners, buckets = [], []
    rolled = np.zeros(len(data), np.uint32)
    for n in range(1, max(SIZES) + 1):
        shifted = np.zeros(len(data), np.uint32)
        shifted[: len(data) - n + 1] = data[n - 1 :]
        rolled = rolled * np.uint32(0x01000193) + shifted + np.uint32(1)
        if n in SIZES:
            fits = room >= n
            mixed = (rolled[fits] ^ (rolled[fits] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            owners.append(owner[fits])
            buckets.append((mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64))
    # the word itself: its bytes weighted by place
    place = (np.arange(len(data)) - (ends - sizes)[owner] + 1).astype(np.uint32)
    whole = np.bincount(owner, ((data * np.uint32(0x9E3779B1)) ^ (place * np.uint32(0xC2B2AE35))).astype(np.float64), minlength=len(words))
    owners.append(np.arange(len(words)))
    buckets.append(((whole.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of each window; a text's windows are of nearly equal size, ``WINDOW`` words at most."""
    each = -(-counts // WINDOW)
    text = np.repeat(np.arange(len(counts)), each)
    number = spread_ranges(np.zeros(len(counts), np.int64), each)
    begin = (np.cumsum(counts) - counts)[text]
    first = number * counts[text] // np.maximum(each[text], 1)
    after = (number + 1) * counts[text] // np.maximum(each[text], 1)
    return text, begin + first, after - first


def distinct_places(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """True at one place of each word in each group, groups being numbered upwards."""
    keys = group.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
    once = np.zeros(len(words), bool)
    once[np.unique(keys, return_index=True)[1]] = True
    return once


@dataclass
class Model:
    """What scoring needs of embeddings and softmax: a margin for each bucket, and the bias."""

    margins: np.ndarray
    bias: float

    def words(self, words: list[bytes]) -> np.ndarray:
        owner, bucket = ngrams(words)
        return np.bincount(owner, self.margins[bucket], minlength=len(words)) / np.bincount(owner, minlength=len(words))

    def texts(self, words: np.ndarray, margins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability to be toxic of each text, from the numbers of all words on end and each number's margin."""
        text, begin, size = windows(counts)
        worst = np.zeros(len(counts))
        if len(text):
            once = distinct_places(words, np.repeat(np.arange(len(text)), size))
            of_window = np.add.reduceat(margins[words] * once, begin) / np.maximum(size, LEAST_WINDOW)
            worst[counts > 0] = np.maximum.reduceat(of_window, np.flatnonzero(np.diff(text, prepend=-1)))
        return 1 / (1 + np.exp(-np.clip(worst + self.bias, -50, 50)))


def _grams(words: list[bytes], at_once: int = 1 << 15) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for at in range(0, len(words), at_once):
        yield (at, *ngrams(words[at : at + at_once]))


def fit(texts: list[str], labels: np.ndarray, seed: int = 1) -> Model:
    """Train embeddings and softmax together, by Adam over all sampled texts; without both classes the score is even."""
    margins = np.zeros(1 << BUCKET_BITS, np.float32)
    if len(texts) == 0 or labels.min() == labels.max():
        return Model(margins, 0.0)
    lists = [tokens(t) for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    number: dict[bytes, int] = {}
    places = np.fromiter((number.setdefault(w, len(number)) for words in lists for w in words), np.int32, int(counts.sum()))
    del lists
    names = list(number)
    once = distinct_places(places, np.repeat(np.arange(len(counts)), counts))
    in_texts = np.bincount(places[once], minlength=len(number))  # texts of each word
    seen, grams = np.zeros(1 << BUCKET_BITS), np.zeros(len(number), np.float32)
    for at, owner, bucket in _grams(names):
        seen += np.bincount(bucket, in_texts[owner + at], minlength=len(seen))
        grams += np.bincount(owner + at, minlength=len(grams))
    used = np.flatnonzero(seen >= LEAST_SEEN)
    if not len(used):
        return Model(margins, 0.0)
    place_of = np.full(len(seen), -1, np.int32)
    place_of[used] = np.arange(len(used))
    kept = [(owner + at, place_of[bucket]) for at, owner, bucket in _grams(names)]
    owner = np.concatenate([o[b >= 0].astype(np.int32) for o, b in kept])
    bucket = np.concatenate([b[b >= 0] for _, b in kept])
    del names, kept, seen
    share = 1 / grams
    text, begin, size = windows(counts)
    whole = once
    counted = distinct_places(places, np.repeat(np.arange(len(text)), size))
    size = np.maximum(size, LEAST_WINDOW)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (len(used), WIDTH))
    softmax, bias = rng.normal(0, 0.3, (WIDTH, 2)), np.zeros(2)
    weight = np.where(labels == 1, TOXIC_WEIGHT / (labels == 1).sum(), (1 - TOXIC_WEIGHT) / (labels == 0).sum())
    parameters = [vectors, softmax, bias]
    first, second = [np.zeros_like(p) for p in parameters], [0.0] * len(parameters)
    has_words = counts > 0
    starts, lengths = (np.cumsum(counts) - counts)[has_words], counts[has_words]
    spans = np.diff(np.append(begin, len(places)))
    for step in range(1, STEPS + 1):
        along = softmax[:, 1] - softmax[:, 0]
        word = (np.bincount(owner, (vectors @ along).astype(np.float32)[bucket], minlength=len(number)) * share)[places]
        if step <= WHOLE_TEXT_STEPS:  # until the vectors say something, a text is one window
            at, along_text, sizes, counts_once = starts, lengths, np.maximum(lengths, LEAST_WINDOW), whole
            of_text = np.add.reduceat(word * whole, starts) / sizes
        else:
            of_window = np.add.reduceat(word * counted, begin) / size
            ranked = np.lexsort((of_window, text))
            chosen = ranked[np.flatnonzero(np.diff(text[ranked], append=-1))]  # the window with the largest margin
            at, along_text, sizes, counts_once, of_text = begin[chosen], spans[chosen], size[chosen], counted, of_window[chosen]
        margin = np.full(len(counts), bias[1] - bias[0])
        margin[has_words] += of_text
        slope = weight * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels)
        where = spread_ranges(at, along_text)
        by_place = np.repeat(slope[has_words] / sizes, along_text) * counts_once[where]
        by_word = np.bincount(places[where], by_place, minlength=len(number))
        by_bucket = np.bincount(bucket, (by_word * share).astype(np.float32)[owner], minlength=len(used))
        toward = vectors.T @ by_bucket
        grads = [np.outer(by_bucket, along), np.stack([-toward, toward], axis=1), np.array([-slope.sum(), slope.sum()])]
        for k, (p, g) in enumerate(zip(parameters, grads, strict=True)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * float((g * g).max())
            p -= RATES[k] * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-12)
    margins[used] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return Model(margins, float(bias[1] - bias[0]))


def fit_on(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Model:
    """Model of ``labels.toxic`` from rows whose remainder by 3 is not 1."""
    rows = labelled_sample(docs, labels, "toxic", remainder("doc_id", 3) != 1, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        texts, marks = ([x for b in held for x in b.column(k).to_pylist()] for k in range(2))
        model = fit(texts, np.array(marks, float))
        yield pa.RecordBatch.from_arrays([pa.array([model.margins.tobytes()], pa.binary()), pa.array([model.bias])], names=["margins", "bias"])

    # the sample is bounded, so one task holds it; a driver would have less memory to spare
    ordered = rows.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "label")
    found = ordered.mapInArrow(run, "margins binary, bias double").first()
    return Model(np.frombuffer(found["margins"], np.float32), found["bias"]) if found else fit([], np.zeros(0))


def with_score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """Columns ``keep`` and the score, 0 to 1, of every row; a null or empty text has no words and scores as the bias.

    ``name`` must not be one of ``keep``; any other names may be.
    """
    names = [*(f"c{k}" for k in range(len(keep))), "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        margins = np.zeros(0)
        for batch in slices(batches, "text"):
            lists = [tokens(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            words = [w for words in lists for w in words]
            if len(known) > REMEMBERED:
                known, margins = {}, np.zeros(0)
            new = list(set(words).difference(known))
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                margins = np.concatenate([margins, model.words(new)])
            numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.texts(numbers, margins, counts))], names=names)

    picked = with_text(docs, keep, text_col)
    return picked.mapInArrow(run, StructType([*picked.schema.fields[:-1], StructField("score", DoubleType())])).toDF(*keep, name)


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, that score below ``TOXIC_FROM``."""
    score = unused(docs.columns, "toxic_score")
    scored = with_score(docs, fit_on(docs, labels), docs.columns, name=score)
    return scored.where(F.col(score) < TOXIC_FROM).select(*map(named, docs.columns))


@query("op8_subword_toxicity")
def subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = with_score(docs, fit_on(docs, labels_of(spark, sf_dir)), ["doc_id"])
    return scored.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )

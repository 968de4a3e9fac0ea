"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: the shares of its hashed words (each word hashed once more with the one before
it), its structure statistics (shares of capitals, digits, marks and white space, length of words and lines,
share of distinct words, ...) and metadata (its length), the statistics cut into ranges with one feature per
range.  The score is the logistic function of a linear part and of all pairwise interactions, whose weights are
products of low-rank factors, so they are summed in linear time: half of the squared sum minus the sum of
squares, per factor.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); its size does not depend on the
data.  Scoring is one pass over the texts without a shuffle.

Defined cases: a null text counts as empty; an empty text has no words and is scored by its statistics; with no
labelled rows every score is 0.5; repeated rows come out as often as they occur; other columns are ignored, or
kept by :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from palimpsest.llm.bytewords import SOLID, slices, words_of
from palimpsest.llm.common import documents_of, spare_name
from palimpsest.llm.labelled import training_sample
from palimpsest.llm.suffix_groups import ranges

#: Labelled rows a model is fitted on at most.
SAMPLE_ROWS = 12_000
WORD_FEATURES, RANK, RANGES = 1 << 15, 6, 16
EPOCHS, BATCH, RATE, DECAY = 8, 128, 0.05, 1e-5
SLICE_BYTES = 2 << 20
STATISTICS = 14


@dataclass
class Machine:
    """``cuts``: the inner limits of the ranges of every statistic."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    cuts: np.ndarray


def statistics(words) -> np.ndarray:
    """One row per text; all finite, also for empty texts."""
    data, edges = words.data, words.edges
    size = np.diff(edges).astype(float)
    n = words.counts.astype(float)

    def share(inside: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(inside)]
        return (total[edges[1:]] - total[edges[:-1]]) / np.maximum(size, 1)

    raw = words.raw
    letters = share((data >= 0x61) & (data <= 0x7A))
    lines = share(data == 0x0A)
    space = share(~SOLID[data])
    marks = (data > 0x20) & (data < 0x80) & ~((data >= 0x30) & (data <= 0x39)) & ~((data >= 0x61) & (data <= 0x7A))
    run = np.zeros(len(data), bool)
    run[1:] = marks[1:] & (data[1:] == data[:-1])
    keys = words.keys()
    owner = words.owner
    order = np.lexsort((keys, owner))
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        same[1:] = (keys[order][1:] == keys[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeated = np.bincount(owner[order], same, len(n))
    pairs = np.zeros(len(keys), bool)
    if len(keys) > 1:
        pairs[1:] = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    length = (words.ends - words.starts).astype(float)
    long_ = np.bincount(owner, length > 12, len(n))
    odd = np.bincount(owner, length <= 1, len(n))
    some = np.maximum(n, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(n), letters, share((raw >= 0x41) & (raw <= 0x5A)), share((data >= 0x30) & (data <= 0x39)),
        share(data >= 0x80), space, lines, share(marks), share(run), repeated / some,
        np.bincount(owner, pairs, len(n)) / some, long_ / some, (odd + 1) / some,
    ])


def features(texts: pa.Array, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, values and text of all features, the texts in order."""
    words = words_of(texts, SOLID)
    stats = statistics(words)
    keys, owner = words.keys(), words.owner
    before = np.zeros(len(keys), np.uint64)
    before[1:] = keys[:-1]
    before[words.bounds[:-1][words.counts > 0]] = 0
    pair = (keys ^ (before * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    bucket = np.concatenate([keys >> np.uint64(20), pair >> np.uint64(20)]) % np.uint64(WORD_FEATURES)
    both = np.r_[owner, owner]
    found, times = np.unique(both * np.int64(WORD_FEATURES) + bucket.astype(np.int64), return_counts=True)
    who = found // WORD_FEATURES
    value = times / np.sqrt(np.maximum(np.bincount(who, times.astype(float) ** 2, len(texts)), 1))[who]
    rows = np.arange(len(texts))
    ranged = [
        WORD_FEATURES + k * RANGES + np.searchsorted(cuts[k], stats[:, k], side="right") for k in range(stats.shape[1])
    ]
    number = np.concatenate([found % WORD_FEATURES, *ranged])
    owner = np.concatenate([who, *([rows] * len(ranged))])
    value = np.concatenate([value, np.full(len(rows) * len(ranged), 0.5)])
    order = np.argsort(owner, kind="stable")
    return number[order], value[order], owner[order]


def margin(model: Machine, number, value, owner, n: int) -> np.ndarray:
    """Linear part and interactions of ``n`` texts, whose features lie together."""
    first = np.searchsorted(owner, np.arange(n))
    linear = np.add.reduceat(model.weights[number] * value, first)
    part = model.factors[number] * value[:, None]
    total, squares = np.add.reduceat(part, first), np.add.reduceat(part**2, first)
    return model.bias + linear + 0.5 * (total**2 - squares).sum(1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(sample: DataFrame) -> Machine:
    """A machine from ``text, label``; the sample is bounded, its features are made on the executors."""
    none = np.zeros((STATISTICS, RANGES - 1))

    def describe(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = part.column(part.schema.get_field_index("text"))
                stats = statistics(words_of(texts, SOLID))
                number, value, owner = features(texts, none)
                inside = number < WORD_FEATURES
                edges = np.searchsorted(owner[inside], np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("doc_id")), part.column(part.schema.get_field_index("label")),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(number[inside], pa.int32())),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(value[inside], pa.float32())),
                        pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), STATISTICS).cast(pa.list_(pa.float64())),
                    ],
                    ["doc_id", "label", "number", "value", "stats"],
                )

    rows = (
        sample.select("doc_id", "label", "text")
        .mapInArrow(describe, "doc_id bigint, label int, number array<int>, value array<float>, stats array<double>")
        .toArrow()
        .sort_by("doc_id")
    )
    size = WORD_FEATURES + STATISTICS * RANGES
    rng = np.random.default_rng(0)
    model = Machine(0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)), none)
    if not rows.num_rows:
        model.factors[:] = 0
        return model
    label = rows["label"].to_numpy().astype(float)
    stats = rows["stats"].combine_chunks().flatten().to_numpy().reshape(-1, STATISTICS)
    model.cuts = np.quantile(stats, np.linspace(0, 1, RANGES + 1)[1:-1], axis=0).T
    ranged = np.column_stack([
        WORD_FEATURES + k * RANGES + np.searchsorted(model.cuts[k], stats[:, k], side="right") for k in range(STATISTICS)
    ])
    # The sample's features stay flat arrays: as Python lists they would take half a gigabyte.
    held = rows["number"].combine_chunks()
    sizes = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    all_numbers = held.flatten().to_numpy()
    all_values = rows["value"].combine_chunks().flatten().to_numpy()
    del held, rows
    share = np.clip(label.mean(), 0.01, 0.99)
    model.bias = float(np.log(share / (1 - share)))
    seen_w, seen_f = np.full(size, 1e-3), np.full((size, RANK), 1e-3)
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for k in range(0, len(order), BATCH):
            chosen = order[k : k + BATCH]
            at = ranges(begins[chosen], sizes[chosen])
            owner = np.r_[np.repeat(np.arange(len(chosen)), sizes[chosen]), np.repeat(np.arange(len(chosen)), STATISTICS)]
            sort = np.argsort(owner, kind="stable")
            owner = owner[sort]
            number = np.r_[all_numbers[at].astype(np.int64), ranged[chosen].ravel()][sort]
            value = np.r_[all_values[at].astype(float), np.full(len(chosen) * STATISTICS, 0.5)][sort]
            first = np.searchsorted(owner, np.arange(len(chosen)))
            part = model.factors[number] * value[:, None]
            total = np.add.reduceat(part, first)
            score = model.bias + np.add.reduceat(model.weights[number] * value, first)
            score += 0.5 * (total**2 - np.add.reduceat(part**2, first)).sum(1)
            error = (logistic(score) - label[chosen]) / len(chosen)
            model.bias -= RATE * float(error.sum())
            slope = (error[owner] * value)[:, None]
            touched, back = np.unique(number, return_inverse=True)
            step_w = np.bincount(back, slope[:, 0], len(touched)) + DECAY * model.weights[touched]
            change = slope * (total[owner] - part)
            step_f = np.column_stack([np.bincount(back, change[:, f], len(touched)) for f in range(RANK)])
            step_f += DECAY * model.factors[touched]
            seen_w[touched] += step_w**2
            seen_f[touched] += step_f**2
            model.weights[touched] -= RATE * step_w / np.sqrt(seen_w[touched])
            model.factors[touched] -= RATE * step_f / np.sqrt(seen_f[touched])
    return model


def train(docs: DataFrame, labels: DataFrame, use: Column, rows: int = SAMPLE_ROWS) -> Machine:
    return fit(training_sample(docs, labels, "quality", use, rows))


def scores_of(model: Machine, texts: pa.Array) -> np.ndarray:
    if not len(texts):
        return np.zeros(0)
    return logistic(margin(model, *features(texts, model.cuts), len(texts)))


def annotate(docs: DataFrame, model: Machine, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the score as column ``name``, one pass without a shuffle."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # its size is fixed by the constants above

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                score = scores_of(sent.value, part.column(part.schema.get_field_index(text_col)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def keep(docs: DataFrame, model: Machine, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they were.

    A model that saw no labelled row tells nothing about any document: then all of them stay.
    """
    if not model.factors.any():
        return docs
    name = spare_name(docs, "quality_score")
    return annotate(docs, model, name, text_col).filter(F.col(name) >= threshold).drop(name)


def score(docs: DataFrame, model: Machine, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = annotate(documents_of(docs), model, "score")
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))

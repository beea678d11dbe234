"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import small_batches, uniform

WORD_BUCKETS = 1 << 15
STEPS = 16
#: Labelled rows that the model learns from, at most.
SAMPLE = 3000
_MARKS = b"*#$%&|"


def features_of(text: str, metadata: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the text's words, their weights (of length 1 together), and numbers on its structure and metadata."""
    data = text.encode()
    words = Counter(data.lower().split())
    lines = Counter(line for line in data.split(b"\n") if line.strip())
    chars = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    times = np.fromiter(words.values(), dtype=np.float64, count=len(words))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    all_words, all_lines = times.sum(), sum(lines.values())
    n, n_words, n_lines = max(len(data), 1), max(all_words, 1), max(all_lines, 1)
    upper, lower, digits = chars[65:91].sum(), chars[97:123].sum(), chars[48:58].sum()
    marks = chars[33:127].sum() - upper - lower - digits
    mean = float(lengths @ times) / n_words
    starred = sum(n for word, n in words.items() if word[-1] in _MARKS)
    stats = np.array(
        [
            np.log1p(len(data)), np.log1p(all_words), np.log1p(all_lines),
            upper / n, digits / n, marks / n, chars[128:].sum() / n, (chars[32] + chars[9:14].sum()) / n,
            mean, float(((lengths - mean) ** 2) @ times) / n_words, lengths.max(initial=0),
            len(words) / n_words, len(lines) / n_lines, n_words / n_lines,
            (chars[33] + chars[46] + chars[63]) / n_words,
            chars[33] / n_words, chars[124] / n_words, chars[44] / n_words, chars[46] / n_words,
            chars[64] / n_words, chars[47] / n_words, starred / n_words,
            max(lines.values(), default=0) / n_lines, times.max(initial=0) / n_words,
            *metadata,
        ]
    )
    places = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % WORD_BUCKETS
    values = np.log1p(times)
    values /= max(np.sqrt((values**2).sum()), 1e-9)
    return places.astype(np.int32), values.astype(np.float32), stats


@dataclass
class FactorisationMachine:
    """``bias + sum w_i x_i + sum_(i<j) <v_i, v_j> x_i x_j`` and the cuts that turn statistics into features.

    The pairwise sum takes one pass: half of the squared sum of ``v_i x_i`` less the sum
    of their squares.
    """

    cuts: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def features(self, places: np.ndarray, values: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A document's words, and one feature for the step that each statistic falls in."""
        steps = (np.nan_to_num(stats)[:, None] > self.cuts).sum(axis=1)
        own = WORD_BUCKETS + np.arange(len(stats)) * STEPS + steps
        return np.concatenate([places, own]), np.concatenate([values, np.full(len(own), 0.3, np.float32)])

    def margin(self, places: np.ndarray, values: np.ndarray) -> float:
        scaled = self.factors[places] * values[:, None]
        pairs = (scaled.sum(axis=0) ** 2 - (scaled**2).sum(axis=0)).sum() / 2
        return float(self.bias + self.weights[places] @ values + pairs)

    def score(self, text: str, metadata: tuple[float, ...]) -> float:
        margin = self.margin(*self.features(*features_of(text, metadata)))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30.0, 30.0)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], rank: int = 8, epochs: int = 6, rate: float = 0.08) -> FactorisationMachine:
    """AdaGrad on the logistic loss over (places, values, statistics, label) rows, in a fixed order.

    Classes weigh alike, so that a rare one is learned. Every fifth row is held back from that; at the
    end the bias is moved so that the mean score of these rows is the share of label 1 among all.
    Without rows, or of one label only, every score is that label's share (one half without rows).
    """
    n_stats = len(rows[0][2]) if rows else 0
    labels = np.array([row[3] for row in rows], dtype=np.float64)
    share = labels.mean() if len(labels) else 0.5
    size = WORD_BUCKETS + n_stats * STEPS
    prior = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    random = np.random.default_rng(7)
    model = FactorisationMachine(
        np.zeros((n_stats, STEPS - 1)), prior, np.zeros(size, np.float32), (random.normal(0, 0.01, (size, rank))).astype(np.float32)
    )
    if not rows or not 0 < share < 1:
        model.factors[:] = 0
        return model
    stats = np.nan_to_num(np.array([row[2] for row in rows]))
    model.cuts = np.quantile(stats, np.arange(1, STEPS) / STEPS, axis=0).T.copy()
    inputs = [model.features(*row[:3]) for row in rows]
    learned = np.nonzero(np.arange(len(rows)) % 5 != 4)[0]
    if len(np.unique(labels[learned])) < 2:
        learned = np.arange(len(rows))
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    for _ in range(epochs):
        for k in random.permutation(learned):
            places, values = inputs[k]
            scaled = model.factors[places] * values[:, None]
            total = scaled.sum(axis=0)
            margin = model.bias + model.weights[places] @ values + ((total**2).sum() - (scaled**2).sum()) / 2
            slope = weight[k] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[k])
            grad_w = slope * values + 1e-5 * model.weights[places]
            grad_v = slope * values[:, None] * (total - scaled) + 1e-5 * model.factors[places]
            seen_w[places] += grad_w**2
            seen_v[places] += grad_v**2
            seen_b += slope**2
            model.weights[places] -= rate * grad_w / np.sqrt(seen_w[places])
            model.factors[places] -= rate * grad_v / np.sqrt(seen_v[places])
            model.bias -= rate * slope / np.sqrt(seen_b)
    held = np.setdiff1d(np.arange(len(rows)), learned)
    margins = np.array([model.margin(*inputs[k]) for k in (held if len(held) else learned)])
    model.bias += _shift(margins, share)
    return model


def _shift(margins: np.ndarray, share: float) -> float:
    """What to add to the margins so that the mean score is the share, by halving an interval."""
    low, high = -60.0, 60.0
    for _ in range(60):
        middle = (low + high) / 2
        mean = (1 / (1 + np.exp(-np.clip(margins + middle, -60, 60)))).mean()
        low, high = (middle, high) if mean < share else (low, middle)
    return (low + high) / 2


def _numbers(metadata: tuple[str, ...], docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[name].cast("double"), F.lit(-1.0)) for name in metadata]


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    metadata: tuple[str, ...] = ("n_chars",),
    sample: int = SAMPLE,
) -> FactorisationMachine:
    """Learn from the labelled documents for whose key ``learn`` (a condition on ``labels``) holds.

    Of these, the ``sample`` with the smallest hash of the key are read, which bounds the
    rows that are sent to their documents and fitted on the driver. Labels other than 0
    and 1 and null keys are left out; a key labelled twice counts with its smaller label, and each
    of repeated documents with it. Empty tables give a model without a cut, whose scores are all alike.
    """
    chosen = (
        labels.where(learn & labels[label].isin(0, 1) & labels[key].isNotNull())
        .groupBy(labels[key].alias("labelled"))
        .agg(F.min(labels[label]).cast("int").alias("label"))
        .orderBy(uniform(F.col("labelled")), "labelled")
        .limit(sample)
    )
    numbers = F.array(*_numbers(metadata, docs)).cast("array<double>").alias("numbers")
    asked = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"), numbers).join(
        F.broadcast(chosen), F.col("key") == F.col("labelled")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            found = [features_of(t, tuple(m)) for t, m in zip(rows["text"], rows["numbers"])]
            columns = [
                pa.array(rows["key"], batch.schema.field("key").type),
                pa.array([f[0] for f in found], pa.list_(pa.int32())),
                pa.array([f[1] for f in found], pa.list_(pa.float32())),
                pa.array([f[2] for f in found], pa.list_(pa.float64())),
                pa.array(rows["label"], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "places", "values", "stats", "label"])

    kind = asked.schema["key"].dataType.simpleString()
    schema = f"key {kind}, places array<int>, values array<float>, stats array<double>, label int"
    found = asked.select("key", "text", "numbers", "label").mapInArrow(run, schema).toArrow()
    found = found.sort_by("key").to_pydict()
    rows = [
        (np.array(p, np.int32), np.array(v, np.float32), np.array(s), y)
        for p, v, s, y in zip(found["places"], found["values"], found["stats"], found["label"])
    ]
    return fit(rows)


def score(docs: DataFrame, model: FactorisationMachine, text: str = "text", metadata: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); columns of these names are replaced.

    A null text counts as empty; all rows are kept and repeated rows score alike.
    """
    rest = [name for name in docs.columns if name.lower() not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches, "__text", 8 << 20):
            texts = batch.column(batch.num_columns - 2)
            numbers = batch.column(batch.num_columns - 1).to_pylist()
            if len(model.cuts):
                found = np.array([model.score(t.as_py() or "", tuple(m)) for t, m in zip(texts, numbers)])
            else:
                found = np.full(batch.num_rows, 1 / (1 + np.exp(-model.bias)))
            predicted = pa.array((found >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(found, pa.float64()), predicted], names=[*rest, "score", "predicted"]
            )

    numbers = F.array(*_numbers(metadata, docs)).cast("array<double>").alias("__numbers")
    chosen = docs.select(*(docs[c] for c in rest), docs[text].alias("__text"), numbers)
    schema = chosen.select(rest).schema.add("score", "double").add("predicted", "integer")
    return chosen.mapInArrow(run, schema)

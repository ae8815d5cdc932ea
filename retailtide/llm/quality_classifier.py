"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A text is a set of hashed n-grams: of its bytes, and of word shapes (letter case, symbols, whether a
word repeats the one before or its pair was seen before). Indicators are scaled by the log ratio of
their smoothed shares in the two classes, rows are brought to unit length, and a linear hinge-loss
model is fitted by dual coordinate descent. A logistic curve, fitted on rows that the model did not
see, turns the margin into a score between 0 and 1.

The class counts come from every labelled training row, summed by Spark per n-gram (``BUCKETS`` of
them). Only the linear fit uses a bounded sample: about ``FIT_ROWS`` labelled rows, chosen by a hash
of the id, every fifth of which serves the curve. Scoring is one pass without a shuffle.

Defined cases: a null or empty text has no n-gram and gets the score of margin 0. Labels that are
null, or whose id is null, teach nothing; an id with several labels counts with the smallest; rows
that share an id each count as a labelled text. If only one class, or none, is labelled, every score is
the smoothed share of class 1. An empty table gives no rows. Repeated rows are scored each. Other
columns, also such as are named like a result, are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.llm.texts import Texts, give_back, mix, runs, slices
from retailtide.operators.bounded import broadcast_if_small
from retailtide.session import shared_folder

BUCKETS = 1 << 16
FIT_ROWS = 10_000
EPOCHS = 20
COST = 1.0
THRESHOLD = 0.3
LABEL_BYTES = 16 * 1024 * 1024
_ROWS_AT_ONCE = 250

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'-"]] = True


def _buckets(codes: np.ndarray, kind: int) -> np.ndarray:
    return (mix(codes.astype(np.uint64) + np.uint64(kind << 40)) >> np.uint64(48)).astype(np.int64)


def _shapes(t: Texts) -> np.ndarray:
    """A small number for what each word looks like."""
    count = lambda marked: np.add.reduceat(
        np.append(marked.astype(np.int32), 0), np.column_stack([t.starts, t.ends]).ravel()
    )[::2]
    upper = count((t.data >= 65) & (t.data <= 90))
    lower = count((t.data >= 97) & (t.data <= 122))
    case = np.where(upper == 0, 0, np.where(lower == 0, 2, 1)) + 3 * ((upper + lower) == 0)
    words = t.hashes()
    owner = np.repeat(mix(np.arange(len(t), dtype=np.uint64) + np.uint64(1)), t.n_words)
    pairs = mix(np.concatenate([owner[:1], words[:-1]]) * np.uint64(3) + words) ^ owner
    order = np.argsort(pairs, kind="stable")
    seen = np.zeros(len(words), bool)
    seen[order[1:]] = pairs[order][1:] == pairs[order][:-1]
    echo = np.zeros(len(words), bool)
    echo[1:] = words[1:] == words[:-1]
    first = t.first[:-1][t.n_words > 0]
    echo[first] = False
    return case + 6 * (count(_SYMBOL[t.data]) > 0) + 12 * echo + 24 * seen


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram buckets of each text: row numbers, ascending, and buckets."""
    t = Texts(column)
    present = np.zeros(len(t) * BUCKETS, bool)
    sizes = np.diff(t.offsets)
    data = t.data.astype(np.int32)
    for n in (1, 2, 3):
        counts = np.maximum(sizes - n + 1, 0)
        if counts.sum():
            row = np.repeat(np.arange(len(t)), counts)
            at = np.repeat(t.offsets[:-1], counts) + runs(counts)
            code = data[at]
            for j in range(1, n):
                code = (code << 8) | data[at + j]
            present[row * BUCKETS + _TABLES.look(n, code)] = True
    if len(t.starts):
        shapes = _shapes(t)
        for n in (1, 2, 4, 6):
            counts = np.maximum(t.n_words - n + 1, 0)
            at = t.windows(n)
            if len(at):
                code = shapes[at]
                for j in range(1, n):
                    code = code * 48 + shapes[at + j]
                row = np.repeat(np.arange(len(t)), counts)
                present[row * BUCKETS + _buckets(code, 10 + n)] = True
    found = np.flatnonzero(present)
    return found // BUCKETS, found % BUCKETS


class _Tables:
    """Buckets of byte n-grams, looked up instead of hashed again for each byte."""

    def __init__(self):
        self._made: dict[int, np.ndarray] = {}

    def look(self, n: int, code: np.ndarray) -> np.ndarray:
        if n > 2:
            return _buckets(code, n)
        if n not in self._made:
            self._made[n] = _buckets(np.arange(1 << 8 * n), n)
        return self._made[n][code]


_TABLES = _Tables()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield from slices(batch.slice(start, _ROWS_AT_ONCE), "text")


@dataclass
class Model:
    """Weights per bucket (ratio times fitted weight), squared ratios for the row length, the curve."""

    weights: np.ndarray
    squares: np.ndarray
    slope: float
    shift: float

    def score(self, column: pa.Array) -> np.ndarray:
        row, bucket = ngrams(column)
        total = np.bincount(row, self.weights[bucket], len(column))
        length = np.sqrt(np.bincount(row, self.squares[bucket], len(column)))
        margin = np.divide(total, length, out=np.zeros(len(column)), where=length > 0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class counts per n-gram of a task's rows, and the n-grams of the rows to fit on."""
    grams_type = pa.list_(pa.int32())
    schema = pa.schema(
        [
            ("bucket", pa.int32()),
            ("n0", pa.int64()),
            ("n1", pa.int64()),
            ("label", pa.int32()),
            ("fit", pa.int64()),
            ("grams", grams_type),
        ]
    )
    counts = np.zeros((2, BUCKETS + 1), np.int64)  # the last is the number of rows
    for part in _parts(batches):
        row, bucket = ngrams(part.column("text"))
        label = part.column("quality").to_numpy(zero_copy_only=False).astype(np.int64)
        for kind in (0, 1):
            counts[kind, :-1] += np.bincount(bucket[label[row] == kind], minlength=BUCKETS)
            counts[kind, -1] += int((label == kind).sum())
        fit = part.column("fit").to_numpy(zero_copy_only=False)
        chosen = np.flatnonzero(fit >= 0)
        if len(chosen):
            begin, end = np.searchsorted(row, chosen), np.searchsorted(row, chosen, side="right")
            grams = [bucket[b:e].astype(np.int32) for b, e in zip(begin, end)]
            none = pa.nulls(len(chosen), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    none.cast(pa.int32()),
                    none,
                    none,
                    pa.array(label[chosen], pa.int32()),
                    pa.array(fit[chosen], pa.int64()),
                    pa.array(grams, grams_type),
                ],
                schema=schema,
            )
    used = np.flatnonzero(counts.sum(0))
    if len(used):
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array(counts[0, used]),
                pa.array(counts[1, used]),
                none.cast(pa.int32()),
                none,
                pa.nulls(len(used), grams_type),
            ],
            schema=schema,
        )


def descend(
    rows: list[np.ndarray],
    values: Sequence[np.ndarray],
    signs: np.ndarray,
    costs: np.ndarray,
    epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights of a linear hinge-loss model, by dual coordinate descent; rows have unit length."""
    weights, alpha = np.zeros(BUCKETS), np.zeros(len(rows))
    order = np.random.Generator(np.random.PCG64(5))
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            if not len(rows[i]):
                continue
            value = values[i]
            gradient = signs[i] * (weights[rows[i]] @ value) - 1
            new = min(max(alpha[i] - gradient, 0.0), costs[i])
            if new != alpha[i]:
                weights[rows[i]] += (new - alpha[i]) * signs[i] * value
                alpha[i] = new
    return weights


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, by Newton steps on softened labels."""
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * slope, (p - target).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(slope, 0.0)), float(shift)


class _Scaled:
    """The ratios of each row's n-grams, at unit length; made when asked for, as all of them are large."""

    def __init__(self, grams: list[np.ndarray], ratio: np.ndarray):
        self._grams, self._ratio = grams, ratio
        self._norms = [max(np.linalg.norm(ratio[g]), 1e-12) for g in grams]

    def __len__(self) -> int:
        return len(self._grams)

    def __getitem__(self, i: int) -> np.ndarray:
        return self._ratio[self._grams[i]] / self._norms[i]


def fit(counts: np.ndarray, grams: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model from class counts per n-gram (last entry: rows of the class) and the rows to fit on."""
    n0, n1 = counts[:, -1]
    if not n0 or not n1 or len(set(labels.tolist())) < 2:
        share = (n1 + 1) / (n0 + n1 + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, float(np.log(share / (1 - share))))
    share = (counts[:, :-1] + 1) / (counts[:, -1:] + 2)
    ratio = np.log(share[1] / share[0])
    held = np.arange(len(grams)) % 5 == 0
    learn = np.flatnonzero(~held)
    size = np.bincount(labels[learn], minlength=2)
    costs = COST * len(learn) / (2 * np.maximum(size[labels[learn]], 1))
    rows, others = [grams[i] for i in learn], [grams[i] for i in np.flatnonzero(held)]
    weights = descend(rows, _Scaled(rows, ratio), 2.0 * labels[learn] - 1, costs)
    margins = np.array([weights[g] @ v for g, v in zip(others, _Scaled(others, ratio))])
    slope, shift = _curve(margins, labels[held])
    return Model(ratio * weights, ratio**2, slope, shift)


def held_out(folds: int = 5):
    return F.crc32(F.col("doc_id").cast("string")) % folds == 0


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, training=None) -> Model:
    """Learn from labelled documents; ``training`` is a condition on ``doc_id``, by default not held out."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .filter(~held_out() if training is None else training)
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    total = known.count()
    million = 1_000_000
    part = min(million, -(-million * FIT_ROWS // max(total, 1)))
    place = F.xxhash64(F.lit(17), "doc_id")
    chosen = F.pmod(place, F.lit(million)) < part
    known = known.withColumn(
        "fit", F.when(chosen, F.pmod(F.shiftright(place, 20), F.lit(2**40))).otherwise(-1)
    )
    rows = docs.select("doc_id", F.col("text").cast("string")).join(
        broadcast_if_small(known, LABEL_BYTES), "doc_id"
    )
    made = rows.select("text", "quality", "fit").mapInArrow(
        _learned, "bucket int, n0 long, n1 long, label int, fit long, grams array<int>"
    )
    folder = shared_folder(spark, "quality")
    made.write.parquet(folder)
    made = spark.read.parquet(folder)
    per_gram = made.filter("bucket is not null").groupBy("bucket")
    sums = per_gram.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    at = sums.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = sums.column("n0").to_numpy(), sums.column("n1").to_numpy()
    sample = made.filter("label is not null").select("fit", "label", "grams").toArrow().sort_by("fit")
    model = _fitted(counts, sample)
    del sums, sample
    give_back()
    return model


def _fitted(counts: np.ndarray, sample: pa.Table) -> Model:
    grams = [g.values.to_numpy() for g in sample.column("grams")]
    return fit(counts, grams, sample.column("label").to_numpy())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(model.score(part.column("text")))], ["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        scored, "doc_id long, score double"
    )


def filter_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with at least that score, all columns as they came, each judged by its own text."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield part.filter(pa.array(model.score(part.column("text")) >= threshold))

    return docs.mapInArrow(kept, docs.schema)

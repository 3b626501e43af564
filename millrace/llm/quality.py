"""Quality by ordinal cumulative-link regression on graded ratings.

All grades share one weight per hashed feature of a text; ordered thresholds cut
the resulting line into grades: P(grade <= k) = 1 / (1 + exp(w.x - t_k)). The
model gives the expected grade and the probability of a grade or better.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import LOWER, mix, slices, span_hashes, text_bytes, word_spans

FEATURES = 1 << 15
#: Labelled rows that the model is fitted on, the lowest by a hash of the id.
MAX_LABELLED = 8_000
STEPS = 200


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of every row as (bounds, feature, value): words, their shapes, repetitions.

    A feature's value is the root of its share among the row's features, so that
    every row has length one whatever its number of words.
    """
    starts, ends = word_spans(data, bounds)
    rows = np.searchsorted(starts, bounds)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(rows))
    if not len(starts):
        return np.zeros(len(bounds), np.int64), np.zeros(0, np.int64), np.zeros(0)
    lower = LOWER[data]
    word = span_hashes(lower, starts, ends)
    changed = np.concatenate([[0], np.cumsum(lower != data)])
    capitals = changed[ends] - changed[starts]
    size = ends - starts
    kind = np.where(capitals == 0, 0, np.where(capitals * 2 < size, 1, 2))
    letter = ((lower >= 97) & (lower <= 122)) | (lower >= 128)
    lettered = np.concatenate([[0], np.cumsum(letter)])
    marks = size - (lettered[ends] - lettered[starts])
    last, last2 = lower[ends - 1].astype(np.uint64), lower[np.maximum(ends - 2, starts)].astype(np.uint64)
    tail = np.where(letter[ends - 1], np.uint64(0), last * np.uint64(256) + np.where(letter[np.maximum(ends - 2, starts)], np.uint64(0), last2))
    shape = mix(tail * np.uint64(64) + (kind * 16 + np.minimum(marks, 3) * 4 + np.minimum(size // 4, 3)).astype(np.uint64) + np.uint64(1 << 40))
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    again = mix(same.astype(np.uint64) + np.uint64(1 << 41))
    feature = np.concatenate([word, shape, again]) % np.uint64(FEATURES)
    pairs, counts = np.unique(np.concatenate([owner] * 3) * FEATURES + feature.astype(np.int64), return_counts=True)
    row, feature = pairs // FEATURES, pairs % FEATURES
    share = np.sqrt(counts / (3.0 * np.diff(rows)[row]))
    return np.searchsorted(row, np.arange(len(bounds))), feature, share


@dataclass
class OrdinalModel:
    """Shared weights, thresholds in ascending order, and the grades they separate."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def position(self, rows: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Place of each row on the line of the grades."""
        sums = np.concatenate([[0.0], np.cumsum(self.weights[feature] * value)])
        return sums[rows[1:]] - sums[rows[:-1]]

    def at_least(self, position: np.ndarray) -> np.ndarray:
        """P(grade above the k-th threshold), one column per threshold."""
        return 1 / (1 + np.exp(-np.clip(position[:, None] - self.thresholds, -500, 500)))

    def expected(self, position: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.at_least(position) @ np.diff(self.grades)

    @classmethod
    def fit(cls, rows: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, ridge: float = 2e-4):
        """Maximum likelihood with a small ridge, by Adam steps over all rows.

        The first threshold and the logarithms of the gaps are free, so the
        thresholds stay ordered. With a single grade there is no threshold.
        """
        grades, level = np.unique(grade, return_inverse=True)
        cuts = len(grades) - 1
        model = cls(np.zeros(FEATURES), np.zeros(cuts), grades.astype(float))
        if not cuts:
            return model
        below = np.array([np.mean(level <= k) for k in range(cuts)])
        start = np.log(below / (1 - below))
        free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
        parameters = np.concatenate([model.weights, free])
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        first, second = np.zeros_like(parameters), np.zeros_like(parameters)
        for step in range(1, STEPS + 1):
            model.weights, free = parameters[:FEATURES], parameters[FEATURES:]
            model.thresholds = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
            above = model.at_least(model.position(rows, feature, value))
            padded = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], 1)
            upper, lower = padded[np.arange(len(level)), level], padded[np.arange(len(level)), level + 1]
            p = np.maximum(upper - lower, 1e-12)
            du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
            by_position = -(du - dl) / len(level)
            by_weight = np.bincount(feature, weights=value * by_position[owner], minlength=FEATURES) + ridge * model.weights
            by_cut = np.zeros(cuts)
            np.add.at(by_cut, level[level > 0] - 1, du[level > 0] / len(level))
            np.add.at(by_cut, level[level < cuts], -dl[level < cuts] / len(level))
            chain = np.concatenate([[by_cut.sum()], [np.exp(free[j]) * by_cut[j:].sum() for j in range(1, cuts)]])
            gradient = np.concatenate([by_weight, chain])
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            parameters = parameters - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        model.weights, free = parameters[:FEATURES], parameters[FEATURES:]
        model.thresholds = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
        return model


def fit(docs: DataFrame, ratings: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> OrdinalModel | None:
    """Model from rated texts (``ratings``: doc_id, grade); None without any.

    Rows with null id or grade are not used; of several grades of one id the lowest
    counts. At most MAX_LABELLED rows are used, those whose id hashes lowest.
    """
    usable = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(
        F.min(F.col("grade").cast("double")).alias("grade")
    )
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rated = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "grade")

    def extract(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows, feature, value = features(*text_bytes(part.column("text")))
                cut = [slice(a, b) for a, b in zip(rows[:-1], rows[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("grade"),
                        pa.array([feature[c].astype("<u2").tobytes() for c in cut], pa.binary()),
                        pa.array([value[c].astype("<f4").tobytes() for c in cut], pa.binary()),
                    ],
                    names=["grade", "feature", "value"],
                )

    found = rated.mapInArrow(extract, "grade double, feature binary, value binary").toPandas()
    if found.empty:
        return None
    feature = [np.frombuffer(f, "<u2") for f in found["feature"]]
    rows = np.concatenate([[0], np.cumsum([len(f) for f in feature])])
    value = np.concatenate([np.frombuffer(v, "<f4") for v in found["value"]]).astype(float)
    return OrdinalModel.fit(rows, np.concatenate(feature).astype(np.int64), value, found["grade"].to_numpy())


def grade(
    docs: DataFrame, model: OrdinalModel | None, at_least: float | None = None, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, expected_grade, tail_probability (of ``at_least`` or better), kept (tail of a half or more).

    ``at_least`` is the highest grade if not given. Null and empty texts have no
    features and sit at the line's zero. Without a model all three values are null.
    Repeated rows and null ids are kept; other columns are not read.
    """
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = wanted.schema["doc_id"].dataType.simpleString()
    if model is None:
        nothing = [F.lit(None).cast(t).alias(n) for n, t in (("expected_grade", "double"), ("tail_probability", "double"), ("kept", "boolean"))]
        return wanted.select("doc_id", *nothing)
    wished = model.grades[-1] if at_least is None else at_least
    cut = int(np.searchsorted(model.grades, wished)) - 1  # threshold below the wished grade

    def judge(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                position = model.position(*features(*text_bytes(part.column("text"))))
                n = len(position)
                tail = np.ones(n) if cut < 0 else np.zeros(n) if cut >= len(model.thresholds) else model.at_least(position)[:, cut]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.expected(position)), pa.array(tail), pa.array(tail >= 0.5)],
                    names=["doc_id", "expected_grade", "tail_probability", "kept"],
                )

    return wanted.mapInArrow(judge, f"doc_id {id_type}, expected_grade double, tail_probability double, kept boolean")

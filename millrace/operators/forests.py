"""Forests over counted cells: features are cut into bins, equal rows are counted, trees grow in NumPy.

A tree compares features with a few thresholds only, so rows that lie in the same bins everywhere are
alike to it. Here every row is packed into a few 64-bit words of bins and label, equal rows are counted
by Spark, and every tree is grown by one task over all counted cells. Nothing is left out: a table
without equal cells has every row among them.
"""

from __future__ import annotations

import json
import pickle
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path, stage

#: Rows coded together; a feature has no more different values in them, so that 16 bits code each.
CHUNK = 1 << 16
#: Rows of a sample that a step of a level looks at together; its arrays stay in the cache of a core.
STEP = 1 << 16
#: Nodes that are sent to the driver in one piece.
NODES_AT_ONCE = 1_000_000

VALUE = pa.struct([("feature", pa.int32()), ("value", pa.float64()), ("n", pa.int64()), ("last", pa.int32())])
CHUNKS = "payload binary, features int, top bigint, summary array<struct<feature: int, value: double, n: bigint, last: int>>"
NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


# rows to coded chunks


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features by row, labels and counts of at most CHUNK rows."""
    held, rows = [], 0

    def out():
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("f").chunk(0)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        f = flat.reshape(len(lists), len(flat) // len(lists))
        return f, table.column("y").to_numpy(), table.column("n").to_numpy()

    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, CHUNK - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == CHUNK:
                yield out()
                held, rows = [], 0
    if rows:
        yield out()


def code_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per chunk: its rows coded by the values of each feature, these values with their counts, and for each
    column of zeros and ones the last such column before it that holds a one in the same row."""
    for f, y, n in _joined(batches):
        coded, summary = [], []
        before = np.full(len(f), -1, np.int32)
        for j in range(f.shape[1]):
            x = np.ascontiguousarray(f[:, j])
            one = x == 1
            if (one | (x == 0)).all():
                values, codes, last = np.array([0.0, 1.0]), np.packbits(one), int(before[one].max(initial=-1))
                before[one] = j
                counts = np.array([n[~one].sum(), n[one].sum()])
            else:
                values, codes = np.unique(x, return_inverse=True)
                counts, codes, last = np.bincount(codes, n).astype(np.int64), codes.astype(np.uint16), -1
            coded.append((values, codes))
            summary += [(j, v, int(c), last) for v, c in zip(values.tolist(), counts) if c]
        yield pa.RecordBatch.from_pydict(
            {
                "payload": [pickle.dumps((coded, y, n), protocol=5)],
                "features": [f.shape[1]],
                "top": [int(y.max())],
                "summary": [[dict(zip(("feature", "value", "n", "last"), s)) for s in summary]],
            },
            schema=pa.schema([("payload", pa.binary()), ("features", pa.int32()), ("top", pa.int64()), ("summary", pa.list_(VALUE))]),
        )


# bins and their places in the words


@dataclass
class Group:
    """Codes of one ordered feature, or of adjacent columns of zeros and ones of which a row has one at most."""

    features: list[int]
    thresholds: np.ndarray | None = None  # None: code k stands for a one in the k-th column, 0 for none
    place: tuple[int, int] = (0, 0)
    start: int = 0

    @property
    def codes(self) -> int:
        return 1 + (len(self.features) if self.thresholds is None else len(self.thresholds))


@dataclass
class Layout:
    """Where the codes of each group, the label and the count of a sample lie in the words of a row."""

    groups: list[Group]
    classes: int
    features: int
    used: list[int] = field(default_factory=list)

    def __post_init__(self):
        self.label = self.put(self.classes)
        self.codes = 0
        for g in self.groups:
            g.place, g.start = self.put(g.codes), self.codes
            self.codes += g.codes

    def put(self, codes: int) -> tuple[int, int]:
        """Word and lowest bit of a new field; a word that ends up without room is followed by another."""
        bits = max(codes - 1, 1).bit_length()
        word = next((i for i, u in enumerate(self.used) if u + bits <= 64), len(self.used))
        if word == len(self.used):
            self.used.append(0)
        self.used[word] += bits
        return word, self.used[word] - bits


def mask(codes: int) -> np.uint64:
    return np.uint64((1 << max(codes - 1, 1).bit_length()) - 1)


def layout_of(chunks: DataFrame, features: int, classes: int, bins: int) -> Layout:
    """Thresholds as near to equal shares of the rows as the values allow, between all values where they are few."""
    values = chunks.select(F.explode("summary").alias("s")).groupBy("s.feature", "s.value").agg(
        F.sum("s.n").alias("n"), F.max("s.last").alias("last")
    )
    values = stage(values, "values")
    known = {
        r["feature"]: r
        for r in values.groupBy("feature").agg(
            F.count("*").alias("size"), F.min("value").alias("low"), F.max("value").alias("high"), F.max("last").alias("last")
        ).collect()
    }
    binary = {j for j, r in known.items() if r["size"] <= 2 and {r["low"], r["high"]} <= {0.0, 1.0}}
    ordered = [j for j, r in known.items() if r["size"] > 1 and j not in binary]
    cuts: dict[int, list[float]] = {j: [] for j in ordered}
    if ordered:
        w = Window.partitionBy("feature").orderBy("value")
        share = F.col("total") / bins
        # the rows below a cut, its nearest multiple of a share, and how near
        nearest = F.greatest(F.lit(1), F.least(F.lit(bins - 1), F.round(F.col("below") / share)))
        found = (
            values.where(F.col("feature").isin(ordered))
            .select("feature", "value", F.lag("value").over(w).alias("prior"), (F.sum("n").over(w) - F.col("n")).alias("below"))
            .join(values.groupBy("feature").agg(F.sum("n").alias("total"), F.count("*").alias("size")), "feature")
            .where(F.col("prior").isNotNull())
            .withColumn("at", F.when(F.col("size") <= bins, F.col("below")).otherwise(nearest).cast("bigint"))
            .groupBy("feature", "at")
            .agg(F.min_by(F.col("prior") / 2 + F.col("value") / 2, F.abs(F.col("below") - F.col("at") * share)).alias("cut"))
        )
        for r in found.collect():
            cuts[r["feature"]].append(r["cut"])
    groups: list[Group] = []
    for j in range(features):
        if j in binary:
            last = groups[-1] if groups else None
            if last and last.thresholds is None and last.features[-1] == j - 1 and known[j]["last"] < last.features[0]:
                last.features.append(j)
            else:
                groups.append(Group([j]))
        elif cuts.get(j):
            groups.append(Group([j], np.unique(cuts[j])))
    return Layout(groups, classes, features)


def pack_chunks(layout: Layout):
    """Chunks to words of codes, one row each, equal ones of a chunk counted."""
    names = [f"w{i}" for i in range(len(layout.used))]

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for payload in (p.as_py() for b in batches for p in b.column("payload")):
            coded, y, n = pickle.loads(payload)
            words = [np.zeros(len(y), np.uint64) for _ in names]
            word, low = layout.label
            words[word] |= y.astype(np.uint64) << np.uint64(low)
            for g in layout.groups:
                code = np.zeros(len(y), np.uint64)
                for k, j in enumerate(g.features, 1):
                    values, codes = coded[j]
                    if g.thresholds is not None:
                        bins = np.searchsorted(g.thresholds, values).astype(np.uint64)
                        code = bins[codes if codes.dtype == np.uint16 else np.unpackbits(codes, count=len(y))]
                    else:
                        code[np.unpackbits(codes, count=len(y)).view(bool)] = k
                words[g.place[0]] |= code << np.uint64(g.place[1])
            if len(words) == 1:
                words[0], back = np.unique(words[0], return_inverse=True)
                n = np.bincount(back, n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*[pa.array(w.view(np.int64)) for w in words], pa.array(n)], names=[*names, "n"])

    return packed, names


def _blobs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells as one binary value per word and batch, which Spark hands on as they are."""
    for b in batches:
        if b.num_rows:
            arrays = [pa.array([np.ascontiguousarray(c.to_numpy(zero_copy_only=False)).tobytes()], pa.binary()) for c in b.columns]
            yield pa.RecordBatch.from_arrays(arrays, names=b.schema.names)


@dataclass
class Cells:
    """Counted cells of a table: staged blobs and their number."""

    blobs: DataFrame
    layout: Layout
    rows: int

    @property
    def task_bytes(self) -> int:
        """Memory of a task that holds all cells with their counts, a sample of them, and half of it moved."""
        return self.rows * (20 * len(self.layout.used) + 8)


def cells_of(dataset: DataFrame, features: str, label: str, count: Column, bins: int) -> Cells | None:
    """The cells of a table with a vector of features and a label; None of a table without rows."""
    whole = F.col(label).cast("double")
    fine = F.coalesce((whole >= 0) & (whole < 1 << 31) & (whole == F.floor(whole)), F.lit(False))
    rows = dataset.select(
        vector_to_array(features).alias("f"),
        F.when(fine, whole.cast("bigint")).otherwise(F.raise_error(F.lit(f"{label} must be the number of a class"))).alias("y"),
        count.cast("bigint").alias("n"),
    )
    chunks = stage(rows.mapInArrow(code_chunks, CHUNKS), "chunks")
    seen = chunks.agg(F.max("features").alias("features"), F.max("top").alias("top")).first()
    if seen["top"] is None:
        return None
    layout = layout_of(chunks, seen["features"], max(seen["top"] + 1, 2), bins)
    packed, names = pack_chunks(layout)
    words = chunks.select("payload").mapInArrow(packed, ", ".join(f"{w} bigint" for w in [*names, "n"]))
    counted = words.groupBy(*names).agg(F.sum("n").alias("n"))
    kinds = ", ".join(f"{w} binary" for w in [*names, "n"])
    blobs = stage(counted.mapInArrow(_blobs, kinds), "cells")
    return Cells(blobs, layout, int(blobs.agg(F.sum(F.length("n")) / 8).first()[0]))


# trees


class Splits:
    """All splits that a layout allows: a row goes right if (word & mask) - low <= span, in unsigned numbers."""

    def __init__(self, layout: Layout):
        self.layout, self.ranges = layout, []
        feature, threshold, word, masks, low, span = [], [], [], [], [], []
        for g in layout.groups:
            w, shift = g.place
            full = int(mask(g.codes)) << shift
            start = len(feature)
            for code in range(1, g.codes):
                ordered = g.thresholds is not None
                feature.append(g.features[0 if ordered else code - 1])
                threshold.append(float(g.thresholds[code - 1]) if ordered else 0.5)
                word.append(w)
                masks.append(full)
                low.append(code << shift)
                span.append(full - (code << shift) if ordered else 0)
            self.ranges.append(slice(start, len(feature)))
        self.feature, self.threshold = np.array(feature, np.int64), np.array(threshold)
        self.word = np.array(word, np.int64)
        self.mask, self.low, self.span = (np.array(x, np.uint64) for x in (masks, low, span))

    def left(self, hists: list[np.ndarray], totals: np.ndarray) -> np.ndarray:
        """Weights by node, class and split of the rows that go left."""
        out = np.empty((*totals.shape, len(self.feature)))
        for g, r, h in zip(self.layout.groups, self.ranges, hists):
            if g.thresholds is not None:
                np.cumsum(h[:, :, :-1], axis=2, out=out[:, :, r])
            else:
                np.subtract(totals[:, :, None], h[:, :, 1:], out=out[:, :, r])
        return out

    def best(self, hists: list[np.ndarray], totals: np.ndarray, drawn: np.ndarray, least: float):
        """The split of greatest gain among the drawn features per node, its gain, and the weights that go left."""
        left = self.left(hists, totals)
        right = totals[:, :, None] - left
        lw, rw, all_w = left.sum(1), right.sum(1), totals.sum(1)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            pure = np.square(left).sum(1) / lw + np.square(right).sum(1) / rw
            gain = (pure - (np.square(totals).sum(1)[:, None] / all_w)) / all_w
        gain[~((lw >= least) & (rw >= least) & drawn[:, self.feature])] = -np.inf
        at = gain.argmax(1)
        nodes = np.arange(len(at))
        return at, gain[nodes, at], left[nodes, :, at]


def impurity(totals: np.ndarray) -> np.ndarray:
    return 1 - np.square(totals / totals.sum(1, keepdims=True)).sum(1)


class Sample:
    """Weighted rows of one tree as packed words, ordered by the node that they have come to."""

    def __init__(self, layout: Layout, words: list[np.ndarray], rows: int, weight: tuple[int, int, np.uint64]):
        self.layout, self.words, self.rows, self.weight = layout, words, rows, weight

    def _fields(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        word, low = self.layout.label
        label = (words[word].view(np.int64) >> low) & int(mask(self.layout.classes))
        word, low, full = self.weight
        return label, ((words[word] >> np.uint64(low)) & full).astype(np.float64)

    def counts(self, words: list[np.ndarray], per_node: np.ndarray) -> list[np.ndarray]:
        """Weights by node, class and code of each group, of rows ordered by node."""
        classes = self.layout.classes
        label, weight = self._fields(words)
        node = np.repeat(np.arange(len(per_node)) * classes, per_node) + label
        out = []
        for g in self.layout.groups:
            word, low = g.place
            key = node * g.codes + ((words[word].view(np.int64) >> low) & int(mask(g.codes)))
            out.append(np.bincount(key, weight, len(per_node) * classes * g.codes).reshape(len(per_node), classes, g.codes))
        return out

    def root(self) -> tuple[np.ndarray, list[np.ndarray]]:
        hists = [np.zeros((1, self.layout.classes, g.codes)) for g in self.layout.groups]
        totals = np.zeros((1, self.layout.classes))
        for a in range(0, self.rows, STEP):
            part = [w[a : min(a + STEP, self.rows)] for w in self.words]
            label, weight = self._fields(part)
            totals[0] += np.bincount(label, weight, self.layout.classes)
            for h, c in zip(hists, self.counts(part, np.array([len(label)]))):
                h += c
        return totals, hists

    def move(self, sizes: np.ndarray, split: dict[str, np.ndarray], keep: np.ndarray, count: np.ndarray, small_right: np.ndarray):
        """Send the rows of each node left or right: the kept left children's rows come first, then the right ones'.

        Returns the rows of each child, and the weights of the smaller child where ``count`` asks for them.
        """
        ends, moved, at = np.cumsum(sizes), [], 0
        to_right = np.zeros(len(sizes), np.int64)
        hists = [np.zeros((len(sizes), self.layout.classes, g.codes)) for g in self.layout.groups]
        for a in range(0, self.rows, STEP):
            b = min(a + STEP, self.rows)
            first, last = (int(x) for x in np.searchsorted(ends, [a, b - 1], side="right"))
            nodes = slice(first, last + 1)
            upto = np.minimum(ends[nodes], b)
            starts = np.concatenate([[a], upto[:-1]])
            per_node = upto - starts

            def rows_of(x: np.ndarray):
                return x[first] if first == last else np.repeat(x[nodes], per_node)

            part = [w[a:b] for w in self.words]
            tested = part[0]
            if len(part) > 1:
                word = rows_of(split["word"])
                for k in range(1, len(part)):
                    tested = np.where(word == k, part[k], tested)
            right = ((tested & rows_of(split["mask"])) - rows_of(split["low"])) <= rows_of(split["span"])
            right_rows = np.add.reduceat(right, starts - a, dtype=np.int64)
            to_right[nodes] += right_rows
            if count[nodes].any():
                picked = (right == rows_of(small_right)) & rows_of(count)
                counted = np.where(small_right[nodes], right_rows, per_node - right_rows) * count[nodes]
                for h, c in zip(hists, self.counts([w[picked] for w in part], counted)):
                    h[nodes] += c
            goes_right = right & rows_of(keep[:, 1])
            moved.append([w[goes_right] for w in part])
            goes_left = ~right & rows_of(keep[:, 0])
            for w, p in zip(self.words, part):
                stay = p[goes_left]
                w[at : at + len(stay)] = stay
            at += len(stay)
        for i in range(len(moved)):
            for w, p in zip(self.words, moved[i]):
                w[at : at + len(p)] = p
            at += len(moved[i][0])
            moved[i] = None
        self.rows = at
        return sizes - to_right, to_right, hists


@dataclass(frozen=True)
class Growth:
    """What bounds a tree, as in Spark's trees."""

    depth: int
    least: int
    per_node: int


def grow(sample: Sample, splits: Splits, rng: np.random.Generator, growth: Growth) -> pa.RecordBatch:
    """One tree, level by level; the weights of a larger child are those of its parent without the smaller child's."""
    layout, least = sample.layout, growth.least
    totals, hists = sample.root()
    sizes, ids = np.array([sample.rows]), np.array([0])
    at_level = [totals]  # weights of all nodes of a level
    split_of, gain_of, child_of = [np.array([-1])], [np.array([-1.0])], [np.full((1, 2), -1)]
    made, per_step = 1, max(1, (1 << 18) // max(1, len(splits.feature)))

    def is_open(t: np.ndarray, level: int) -> np.ndarray:
        return (impurity(t) > 1e-16) & (t.sum(1) >= 2 * least) & (level < growth.depth)

    live = is_open(totals, 0) & (len(splits.feature) > 0)
    level = 0
    if not live[0]:
        sizes = sizes[:0]
    while len(sizes):
        found = []
        for a in range(0, len(sizes), per_step):
            s = slice(a, a + per_step)
            drawn = rng.random((len(sizes[s]), layout.features))
            drawn = drawn <= np.partition(drawn, growth.per_node - 1, axis=1)[:, growth.per_node - 1 : growth.per_node]
            found.append(splits.best([h[s] for h in hists], totals[s], drawn, least))
        best, gain, left = (np.concatenate(x) for x in zip(*found))
        # differences of sums that are equal can come out a little above 0
        parted = gain > 1e-14
        level += 1
        inner = np.flatnonzero(parted)
        left, right = left[inner], totals[inner] - left[inner]
        split_of[-1][ids[inner]], gain_of[-1][ids[inner]] = best[inner], gain[inner]
        child_of[-1][ids[inner]] = made + np.stack([np.arange(len(inner)), np.arange(len(inner)) + len(inner)], axis=1)
        if not len(inner):
            break
        made += 2 * len(inner)
        children = np.concatenate([left, right])
        at_level.append(children)
        split_of.append(np.full(len(children), -1))
        gain_of.append(np.full(len(children), -1.0))
        child_of.append(np.full((len(children), 2), -1))
        opened = is_open(children, level)
        if not opened.any():
            break
        keep = np.zeros((len(sizes), 2), bool)
        keep[inner] = opened.reshape(2, -1).T
        small_right = np.zeros(len(sizes), bool)
        small_right[inner] = right.sum(1) < left.sum(1)
        chosen = {"word": splits.word[best], "mask": splits.mask[best], "low": splits.low[best], "span": splits.span[best]}
        to_left, to_right, small = sample.move(sizes, chosen, keep, keep.any(1), small_right)
        turned = small_right[:, None, None]
        following = []
        for h, s in zip(hists, small):
            large = h - s
            following.append(np.concatenate([np.where(turned, large, s)[keep[:, 0]], np.where(turned, s, large)[keep[:, 1]]]))
        hists = following
        sizes = np.concatenate([to_left[keep[:, 0]], to_right[keep[:, 1]]])
        ids = np.flatnonzero(opened)
        totals = children[ids]
    return _pruned(at_level, split_of, gain_of, child_of, splits)


def _pruned(at_level, split_of, gain_of, child_of, splits: Splits) -> pa.RecordBatch:
    """The nodes of a tree, children after parents. Two leaves of the same class become one, as in Spark's trees."""
    ends = np.cumsum([len(x) for x in at_level])
    totals, split, gain, child = (np.concatenate(x) for x in (at_level, split_of, gain_of, child_of))
    predicted = totals.argmax(1)
    leaf = split < 0
    levels = [np.arange(e - len(x), e) for e, x in zip(ends, at_level)]
    for nodes in reversed(levels):
        inner = nodes[~leaf[nodes]]
        left, right = child[inner].T
        same = leaf[left] & leaf[right] & (predicted[left] == predicted[right])
        leaf[inner[same]], predicted[inner[same]] = True, predicted[left[same]]
    reached = np.zeros(len(leaf), bool)
    reached[0] = True
    for nodes in levels:
        reached[child[nodes[reached[nodes] & ~leaf[nodes]]].ravel()] = True
    number = np.cumsum(reached) - 1
    leaf, child, split = leaf[reached], child[reached], split[reached]
    n, inner = len(leaf), ~leaf
    kids = np.where(inner[:, None], number[child], -1)
    counts, weights = totals[reached], totals[reached].sum(1)
    cuts = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(inner)]), pa.int32()), pa.array(splits.threshold[split[inner]], pa.float64())
    )
    parts = {
        "id": pa.array(np.arange(n), pa.int32()),
        "prediction": pa.array(predicted[reached].astype(np.float64)),
        "impurity": pa.array(impurity(counts)),
        "impurityStats": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * counts.shape[1], pa.int32()), pa.array(counts.ravel())),
        "rawCount": pa.array(weights.astype(np.int64)),
        "gain": pa.array(np.where(inner, gain[reached], -1.0)),
        "leftChild": pa.array(kids[:, 0], pa.int32()),
        "rightChild": pa.array(kids[:, 1], pa.int32()),
        "split": pa.StructArray.from_arrays(
            [pa.array(np.where(inner, splits.feature[split] if len(splits.feature) else -1, -1), pa.int32()), cuts, pa.array(np.full(n, -1), pa.int32())],
            ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
        ),
    }
    return pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(list(parts.values()), list(parts))], names=["nodeData"])


class Bootstrap:
    """Poisson(n) copies of a cell that holds n rows, the sum of Poisson(1) copies of each.

    Small means are drawn by inversion: a uniform number is looked up among the running sums of the probabilities,
    from a first guess by its leading 8 bits.
    """

    SMALL, WIDTH = 32, 160  # beyond 160 the probability for a mean of 32 is below the steps of a double

    def __init__(self, rng: np.random.Generator):
        self.rng, k = rng, np.arange(self.WIDTH)
        logs = np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
        means = np.arange(1, self.SMALL + 1)[:, None]
        sums = np.concatenate([np.ones((1, self.WIDTH)), np.cumsum(np.exp(k * np.log(means) - means - logs), axis=1)])
        sums[:, -1] = np.inf
        self.sums = sums.ravel()
        self.guess = np.concatenate([np.searchsorted(row, np.arange(256) / 256, side="right") for row in sums])

    def __call__(self, n: np.ndarray) -> np.ndarray:
        u, mean = self.rng.random(len(n)), np.minimum(n, self.SMALL).astype(np.intp)
        row = mean * self.WIDTH
        k = self.guess.take(mean * 256 + (u * 256).astype(np.intp))
        beyond = np.flatnonzero(u >= self.sums.take(row + k))
        while len(beyond):
            k[beyond] += 1
            beyond = beyond[u[beyond] >= self.sums.take(row[beyond] + k[beyond])]
        large = np.flatnonzero(n > self.SMALL)
        k[large] = self.rng.poisson(n[large])
        return k.astype(np.uint64)


def drawn_sample(layout: Layout, words: list[np.ndarray], n: np.ndarray, draw: Callable[[np.ndarray], np.ndarray]) -> Sample:
    """A sample that holds each cell as often as drawn."""
    room = Layout(layout.groups, layout.classes, layout.features)
    top = 2 * int(n.max()) + 64  # no draw comes near it
    word, low = room.put(top + 1)
    full = mask(top + 1)
    parts: list[list[np.ndarray]] = []
    for empty_is_all in (False, True):  # a sample of a few rows can be empty
        for a in range(0, len(n), STEP):
            here = n[a : a + STEP]
            drawn = here.astype(np.uint64) if empty_is_all else draw(here)
            if int(drawn.max()) > top:
                raise OverflowError("a draw does not fit its field")
            held = drawn > 0
            part = [w[a : a + STEP][held] for w in words]
            if word == len(part):
                part.append(np.zeros(len(part[0]), np.uint64))
            part[word] |= drawn[held] << np.uint64(low)
            parts.append(part)
        if sum(len(p[0]) for p in parts):
            break
    joined = [np.concatenate(x) for x in zip(*parts)]
    return Sample(layout, joined, len(joined[0]), (word, low, full))


def grow_trees(layout: Layout, numbers: Sequence[int], seed: int, growth: Growth):
    """A task: the trees of these numbers, one after another, over all cells."""

    def grown(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = []
        for b in batches:
            for i in range(b.num_rows):
                columns.append([np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(b.columns, [np.uint64] * len(layout.used) + [np.int64])])
        *words, n = (np.concatenate(x) for x in zip(*columns))
        columns.clear()
        # the order of cells, and with it each draw, does not depend on how the table is partitioned
        order = np.lexsort(words) if len(words) > 1 else np.argsort(words[0])
        words, n = [w[order] for w in words], n[order].astype(np.min_scalar_type(int(n.max())))
        del order
        splits = Splits(layout)
        for i in numbers:
            rng = np.random.Generator(np.random.Philox(key=(seed + i) % (1 << 64)))
            tree = grow(drawn_sample(layout, words, n, Bootstrap(rng)), splits, rng, growth)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(tree.num_rows, i), pa.int32()), tree.column(0)], names=["treeID", "nodeData"])

    return grown


# scores


@dataclass
class Walk:
    """The nodes of all trees one after another; a leaf is its own child. Rows that are not below a threshold, NaN too, go right."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray  # right and left child of each node
    votes: np.ndarray
    levels: list[int]

    @classmethod
    def of(cls, nodes: DataFrame) -> "Walk":
        table = nodes.select(
            "treeID", "nodeData.id", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
            F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        ).toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")]).combine_chunks()
        number = {c: table.column(c).to_numpy() for c in ("treeID", "id", "leftChild", "rightChild", "featureIndex", "threshold")}
        roots = np.flatnonzero(number["id"] == 0)
        start = roots[np.cumsum(number["id"] == 0) - 1]
        leaf, own = number["leftChild"] < 0, np.arange(len(start))
        child = [np.where(leaf, own, start + number[c]) for c in ("rightChild", "leftChild")]
        counts = np.array(table.column("impurityStats").chunk(0).flatten()).reshape(len(start), -1)
        levels = []
        for root, end in zip(roots, [*roots[1:], len(start)]):
            here, deep = np.array([root]), 0
            while len(here := here[~leaf[here]]):
                here, deep = np.concatenate([child[0][here], child[1][here]]), deep + 1
            levels.append(deep)
        return cls(
            roots, np.where(leaf, 0, number["featureIndex"]).astype(np.int64), np.where(leaf, 0.0, number["threshold"]),
            np.stack(child, axis=1).ravel(), counts / counts.sum(1, keepdims=True), levels,
        )

    def classes(self, rows: np.ndarray) -> np.ndarray:
        """The class of the most votes, the first of equal ones, added up tree by tree as Spark's forest does."""
        flat, base = rows.ravel(), np.arange(len(rows)) * rows.shape[1]
        votes = np.zeros((len(rows), self.votes.shape[1]))
        for root, levels in zip(self.roots, self.levels):
            at = np.full(len(rows), root)
            for _ in range(levels):
                left = flat.take(base + self.feature.take(at)) <= self.threshold.take(at)
                at = self.child.take(2 * at + left)
            votes += self.votes.take(at, axis=0)
        return votes.argmax(1)

    def column(self, features: str) -> Column:
        """The class of a vector of features."""

        def score(lists: pa.Array) -> pa.Array:
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            rows = flat.reshape(len(lists), len(flat) // max(len(lists), 1))
            return pa.array(self.classes(rows), pa.int32())

        return F.arrow_udf(score, "int")(vector_to_array(features))


# Spark's model of them


def saved_forest(spark: SparkSession, nodes: DataFrame, trees: Sequence[int], features: int, classes: int) -> str:
    """A folder that Spark loads as a forest of these trees."""
    path = scratch_path(spark, "forest")

    def described(kind: str, uid: str, **more: int) -> str:
        return json.dumps({
            "class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
            "uid": uid, "paramMap": {"impurity": "gini"}, "defaultParamMap": {}, **more,
        })

    whole = described("RandomForestClassificationModel", "forest", numFeatures=features, numClasses=classes, numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    rows = [(i, described("DecisionTreeClassificationModel", f"tree_{i}", numFeatures=features, numClasses=classes), 1.0) for i in trees]
    spark.createDataFrame(rows, "treeID int, metadata string, weights double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes.where(F.col("treeID").between(trees[0], trees[-1])).write.parquet(f"{path}/data")
    return path

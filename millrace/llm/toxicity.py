"""Toxicity by class-conditional Kneser-Ney models of spelling and of neighbouring words.

Every byte of a word is predicted from the ORDER - 1 symbols before it (the word's
start and end are symbols), every word, and the end of the text, from the word
before it. Each class has absolute-discounted counts of these n-grams; what the
discount frees goes to the next shorter context, whose Kneser-Ney continuation
counts both classes share. A text's evidence are the differences of its
log-likelihoods under the two classes, one for spelling and one for neighbours,
over all its n-grams, seen or not, and divided by its length; a logistic curve,
fitted on labelled texts that the counts have not seen, turns them into a score.

For an n-gram that was not counted the classes differ by what their contexts free
alone. So an n-gram adds its context's gain, and a counted one its own difference
from that. Gains and texts stay tables that meet in joins; nothing is collected but
the labelled sample of the curve.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import BYTE_CODES, LOWER, _power, mix, slices, span_hashes, text_bytes, word_spans
from millrace.session import stage

#: Bytes between words: all of ASCII but letters, digits and the apostrophe.
GAPS = np.ones(256, dtype=bool)
GAPS[128:] = False
for _first, _last in ((48, 57), (65, 90), (97, 122), (39, 39)):
    GAPS[_first : _last + 1] = False
#: Symbols of a spelling n-gram; GAPS bytes that mark a word's start and end, and symbols there are.
ORDER = 6
START, END = 0, 1
SYMBOLS = 166
DISCOUNT = 0.75
#: Powers of the number of words that divide a text's evidence: the labelled texts kept apart decide among these.
LENGTH_POWERS = (0.5, 0.75, 1.0)
#: Labelled rows of the highest fold that the curve is drawn through, the lowest by a hash of the id.
MAX_LABELLED = 40_000
#: Salts of the identifiers of pairs, of the end of a text and of contexts.
PAIR, LAST, CONTEXT = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x2545F4914F6CDD1D)


def word_rows(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Words and pairs of rows: distinct (row, id), how often, and for pairs the ids of both words.

    ``start`` and ``end`` give one example of every distinct word ``word``; ``n`` counts the words of each row.
    """
    starts, ends = word_spans(data, bounds, GAPS)
    hashes = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, bounds)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    following = np.append(hashes[1:], LAST)
    following[first[1:][n > 0] - 1] = LAST
    pairs = mix(hashes * np.uint64(3) + mix(following + PAIR))
    ids, at = np.unique(np.concatenate([hashes, pairs]), return_inverse=True)
    both = np.concatenate([row, row]) * len(ids) + at
    found, example, times = np.unique(both, return_index=True, return_counts=True)
    is_pair, of = example >= len(hashes), example % max(len(hashes), 1)
    word, spot = np.unique(hashes, return_index=True)
    return {
        "row": found // max(len(ids), 1), "id": ids[found % max(len(ids), 1)], "times": times, "pair": is_pair,
        "before": hashes[of], "after": following[of], "word": word, "start": starts[spot], "end": ends[spot], "n": n,
    }


def spelling(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """All n-grams of the given words (rows): key, parent (its context, without the last symbol), lower (without the first),
    order, word, and whether it is one that the word's bytes are predicted by."""
    size = np.diff(bounds) + 2
    ends = np.cumsum(size)
    symbols = np.full(int(ends[-1]) if len(ends) else 0, START, np.uint8)
    word = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(symbols)) - (ends - size)[word]
    symbols[place == size[word] - 1] = END
    symbols[(place > 0) & (place < size[word] - 1)] = data
    up, down = _power(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(BYTE_CODES[symbols] * up[:-1], out=sums[1:])

    def key(a, b):
        return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))

    out = []
    for k in range(1, ORDER + 1):
        i = np.flatnonzero(place >= max(k - 1, 1))
        a, b = i - k + 1, i + 1
        top = (place[a] == 0) | (k == ORDER)
        out.append((key(a, b), mix(key(a, b - 1) + CONTEXT), key(a + 1, b), np.full(len(i), k, np.int32), word[i], top))
    return dict(zip(("key", "parent", "lower", "k", "word", "top"), map(np.concatenate, zip(*out))))


def shared(grams: DataFrame) -> DataFrame:
    """lower, share: continuation probability, the same for both classes, of what the longest n-grams end in.

    ``grams``: key, parent, lower, k of every n-gram that occurs. A shorter one counts as often as different
    symbols stand before it; its discount goes to the next shorter one, the last to an even spread.
    """
    known = grams.where("k > 1").groupBy(F.col("lower").alias("key")).agg(F.count(F.lit(1)).alias("c"))
    known = stage(grams.where(f"k < {ORDER}").join(known, "key").select("key", "parent", "lower", "k", "c"), "continuations")
    shares = None
    for k in range(1, ORDER):
        own = known.where(f"k = {k}")
        around = own.groupBy("parent").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
        own = own.join(around, "parent")
        below = F.lit(1 / SYMBOLS)
        if shares is not None:
            own, below = own.join(shares.select(F.col("key").alias("lower"), F.col("share").alias("below")), "lower"), F.col("below")
        level = own.select("key", ((F.col("c") - DISCOUNT + DISCOUNT * F.col("kinds") * below) / F.col("total")).alias("share"))
        shares = level
        levels = level if k == 1 else levels.unionByName(level)
    return stage(levels.withColumnRenamed("key", "lower"), "shares")


def gains(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, gain) of the counted n-grams and (key, gain) of their contexts.

    ``counts``: key, parent, ordinary, toxic (documents) and share (probability of the shorter n-gram).
    """
    around = counts.groupBy("parent").agg(
        *[F.sum(c).alias(f"all{i}") for i, c in enumerate(("ordinary", "toxic"))],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"kinds{i}") for i, c in enumerate(("ordinary", "toxic"))],
    )

    def freed(i: int) -> Column:
        return F.when(F.col(f"all{i}") > 0, DISCOUNT * F.col(f"kinds{i}") / F.col(f"all{i}")).otherwise(1.0)

    def p(i: int, n: Column) -> Column:
        own = F.when(F.col(f"all{i}") > 0, F.greatest(n - DISCOUNT, F.lit(0.0)) / F.col(f"all{i}")).otherwise(0.0)
        return own + freed(i) * F.col("share")

    context = stage(around.withColumn("gain", F.log(freed(1)) - F.log(freed(0))), "contexts")
    own = F.log(p(1, F.col("toxic"))) - F.log(p(0, F.col("ordinary"))) - F.col("gain")
    return counts.join(context, "parent").select("key", own.alias("gain")), context.select(F.col("parent").alias("key"), "gain")


@dataclass
class Model:
    """Gains of spelling and of pairs, and the logistic curve."""

    grams: DataFrame | None = None  # key, gain: of spelling n-grams and contexts
    pairs: DataFrame | None = None  # id, gain: of pairs, and of words as their contexts
    power: float = 1.0
    slopes: tuple[float, float] = (0.0, 0.0)
    offset: float = 0.0


def logistic_curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Slopes, offset and log-loss of the logistic curve through x (columns) and labels y, by Newton steps."""
    scale = np.abs(x).max(0)
    scale[scale == 0] = 1.0
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    loss = lambda w: np.logaddexp(0, np.where(y == 1, -1, 1) * (z @ w)).mean() + 1e-6 * (w @ w)
    now = loss(w)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(x) + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (p - y) / len(x) + 2e-6 * w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        now = loss(w)
    return w[:-1] / scale, float(w[-1]), float(now)


def spelled(words: DataFrame, grams: DataFrame) -> DataFrame:
    """id, spell: gain of the spelling of every word (``words``: id, word)."""

    def spell(batches):
        for batch in batches:
            for part in slices(batch, "word"):
                found = spelling(*text_bytes(part.column("word")))
                ids = np.asarray(part.column("id"))[found["word"][found["top"]]]
                for name in ("key", "parent"):
                    yield pa.RecordBatch.from_pydict({"id": ids, "key": found[name][found["top"]].view(np.int64)})

    listed = words.mapInArrow(spell, "id long, key long").groupBy("id", "key").agg(F.count(F.lit(1)).alias("m"))
    return listed.join(grams, "key").groupBy("id").agg(F.sum(F.col("m") * F.col("gain")).alias("spell"))


def evidence(texts: DataFrame, model: Model, keep: str) -> DataFrame:
    """row, keep, n (words), spell, pair: summed gains of every row of (keep, text)."""
    kept = texts.schema[keep].dataType.simpleString()

    def words(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = text_bytes(part.column("text"))
                data = LOWER[data]
                found = word_rows(data, bounds)
                yield pa.RecordBatch.from_pydict({
                    "id": found["word"].view(np.int64),
                    "word": pa.array([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(found["start"], found["end"])], pa.string()),
                })

    def list_ids(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = text_bytes(part.column("text"))
                found = word_rows(LOWER[data], bounds)
                size = len(part)
                rows = np.concatenate([np.arange(size), found["row"]])
                listed = np.arange(len(rows)) >= size  # after one line for each row itself
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(base + rows), part.column(keep).take(pa.array(rows, mask=listed)),
                        pa.array(np.concatenate([np.zeros(size, np.int64), found["id"].view(np.int64)]), mask=~listed),
                        pa.array(np.concatenate([found["n"], found["times"]]).astype(np.int64)),
                    ],
                    names=["row", keep, "id", "m"],
                )
                base += size

    distinct = texts.select("text").mapInArrow(words, "id long, word string").groupBy("id").agg(F.min("word").alias("word"))
    table = spelled(distinct, model.grams).withColumn("pair", F.lit(0.0)).unionByName(
        model.pairs.select("id", F.lit(0.0).alias("spell"), F.col("gain").alias("pair"))
    ).groupBy("id").agg(F.sum("spell").alias("spell"), F.sum("pair").alias("pair"))
    listed = texts.select(keep, "text").mapInArrow(list_ids, f"row long, {keep} {kept}, id long, m long")
    weighed = listed.join(table, "id", "left")
    own = F.col("id").isNull()
    return weighed.groupBy("row").agg(
        F.max(F.when(own, F.struct(keep)))[keep].alias(keep), F.sum(F.when(own, F.col("m")).otherwise(0)).alias("n"),
        *[F.coalesce(F.sum(F.col("m") * F.col(c)), F.lit(0.0)).alias(c) for c in ("spell", "pair")],
    )


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Models and curve from labelled texts (``labels``: doc_id, toxic, fold).

    Rows of folds below the highest are counted; the highest fold, which these counts
    have not seen, sets the curve. The final gains are then counted over all folds in
    the same way.
    Rows with null label or id are not used. All others are counted; only the curve, of
    three numbers, is drawn through at most MAX_LABELLED rows, those whose id hashes
    lowest. Without texts of both classes every score is the share of the toxic class.
    """
    usable = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"), F.max("fold").alias("fold")
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = stage(texts.join(usable, "doc_id").select("doc_id", "text", "toxic", "fold"), "labelled")
    last, positive, rows = texts.agg(F.max("fold"), F.sum("toxic"), F.count(F.lit(1))).first()
    if not rows or positive in (0, rows):
        return Model(offset=0.0 if not rows else (-30.0 if not positive else 30.0))

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                toxic, apart = np.asarray(part.column("toxic")), np.asarray(part.column("fold")) == last
                for label in (0, 1):
                    for held in (False, True):
                        chosen = part.filter(pa.array((toxic == label) & (apart == held)))
                        data, bounds = text_bytes(chosen.column("text"))
                        data = LOWER[data]
                        found = word_rows(data, bounds)
                        ids, first, n = np.unique(found["id"], return_index=True, return_counts=True)
                        pair = found["pair"][first]
                        at = np.minimum(np.searchsorted(found["word"], ids), max(len(found["word"]) - 1, 0))
                        spans = zip(found["start"][at].tolist(), found["end"][at].tolist(), pair.tolist())
                        yield pa.RecordBatch.from_pydict({
                            "id": ids.view(np.int64), "n": n, "before": pa.array(found["before"][first].view(np.int64), mask=~pair),
                            "after": pa.array(found["after"][first].view(np.int64), mask=~pair),
                            "word": pa.array([None if p else data[a:b].tobytes().decode("utf-8", "replace") for a, b, p in spans], pa.string()),
                            "toxic": np.full(len(n), label, np.int32), "apart": np.full(len(n), held),
                        })

    counted = texts.mapInArrow(count, "id long, n long, before long, after long, word string, toxic int, apart boolean")
    number = lambda label, when: F.sum(F.when((F.col("toxic") == label) & when, F.col("n")).otherwise(0))
    counts = stage(
        counted.groupBy("id").agg(
            F.min("before").alias("before"), F.min("after").alias("after"), F.min("word").alias("word"),
            number(0, ~F.col("apart")).alias("ordinary_seen"), number(1, ~F.col("apart")).alias("toxic_seen"),
            number(0, F.lit(True)).alias("ordinary"), number(1, F.lit(True)).alias("toxic"),
        ),
        "words",
    )
    seen = counts.select("id", "before", "after", "word", F.col("ordinary_seen").alias("ordinary"), F.col("toxic_seen").alias("toxic"))
    apart = texts.where(F.col("fold") == last).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    apart = stage(apart.select("text", "toxic"), "curve")
    judged = evidence(apart, class_models(seen.where("ordinary + toxic > 0")), "toxic").toPandas()
    final = class_models(counts)
    y = judged["toxic"].to_numpy()
    if not 0 < y.sum() < len(y):  # no curve can be drawn through one class
        final.slopes, final.offset = (1.0, 1.0), float(np.log(positive / (rows - positive)))
        return final
    sums, n = judged[["spell", "pair"]].to_numpy(dtype=float), np.maximum(judged["n"].to_numpy(), 1)
    found = [(logistic_curve(sums / n[:, None] ** power, y), power) for power in LENGTH_POWERS]
    (slopes, final.offset, _), final.power = min(found, key=lambda f: f[0][2])
    final.slopes = tuple(map(float, slopes))
    return final


def class_models(counts: DataFrame) -> Model:
    """Gains from counted words and pairs (id, before, after, word, ordinary, toxic)."""

    def spell(batches):
        for batch in batches:
            for part in slices(batch, "word"):
                found = spelling(*text_bytes(part.column("word")))
                keys, first, which = np.unique(found["key"], return_index=True, return_inverse=True)
                total = [np.bincount(which, np.asarray(part.column(c))[found["word"]], len(keys)) for c in ("ordinary", "toxic")]
                yield pa.RecordBatch.from_pydict({
                    "key": keys.view(np.int64), "parent": found["parent"][first].view(np.int64),
                    "lower": found["lower"][first].view(np.int64), "k": found["k"][first], "top": found["top"][first],
                    "ordinary": total[0].astype(np.int64), "toxic": total[1].astype(np.int64),
                })

    listed = counts.where("word is not null").select("word", "ordinary", "toxic")
    grams = stage(
        listed.mapInArrow(spell, "key long, parent long, lower long, k int, top boolean, ordinary long, toxic long")
        .groupBy("key").agg(
            *[F.min(c).alias(c) for c in ("parent", "lower", "k", "top")], F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")
        ),
        "spellings",
    )
    own, context = gains(grams.where("top").join(shared(grams), "lower"))
    spellings = stage(own.unionByName(context).groupBy("key").agg(F.sum("gain").alias("gain")), "spelling-gains")
    pairs = counts.where("before is not null").select(F.col("id").alias("key"), F.col("before").alias("parent"), "after", "ordinary", "toxic")
    kinds = pairs.groupBy("after").agg(F.count(F.lit(1)).alias("c"))
    total = pairs.count()
    own, context = gains(pairs.join(kinds, "after").withColumn("share", F.col("c") / F.lit(float(max(total, 1)))))
    return Model(spellings, stage(own.unionByName(context).withColumnRenamed("key", "id"), "pair-gains"))


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, score, predicted (1 from 0.5 on) of every row.

    Whole texts count; null and empty texts have no evidence and score by the curve's
    offset alone. Repeated rows and null ids are kept; other columns are not read.
    """
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    curve = F.lit(model.offset)
    if model.grams is not None:
        wanted = evidence(wanted, model, "doc_id")
        length = F.pow(F.greatest(F.col("n"), F.lit(1)).cast("double"), F.lit(model.power))
        for slope, c in zip(model.slopes, ("spell", "pair")):
            curve = curve + slope * F.col(c) / length
    result = 1 / (1 + F.exp(-F.greatest(F.least(curve, F.lit(500.0)), F.lit(-500.0))))
    return wanted.select("doc_id", result.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

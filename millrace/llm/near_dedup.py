"""Near duplicates by MinHash signatures and an inverted join over rare shingles.

1. Equal sets become one class; what follows sees one document of each class.
2. Signatures are posted under every (coordinate, value) pair; only documents that
   have enough postings in common with any others at all keep their shingle sets.
3. Shingles are ordered from rare to frequent, once for all. Of two sets that are
   similar enough the first common shingle stands early in both (the prefix), so
   edits of a copy, which few others have, keep it away from copies with other edits.
   In every list of a prefix shingle the most central document, the one with the most
   frequent shingles, is compared with the others. In a group of near copies that is
   the original, so the group becomes one component by about as many comparisons as
   it has members.
4. Lists that still hold several components are joined with themselves: a pair of
   different components passes if sizes and places of the shingle leave room for
   enough common ones. A list is dealt by sizes, so that a document meets only those
   its place allows, and members of its largest component do not meet each other.
   Links inside a component can no longer change the result and are not sought.

Steps 3 and 4 lose no link; every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import SMALL_SLICE, mix, sequence_hashes, slices, text_bytes, word_hashes
from millrace.llm.components import components
from millrace.llm.registry import unused
from millrace.session import stage

WORDS = 5
#: Coordinates of the signature, and by how many standard deviations the matches of a pair
#: may fall short of the average at the similarity asked for. At 0.85 that makes 19 of 32.
SHORT, SHORT_SLACK = 32, 4.0
#: Sizes that differ by less than this factor share a level of a list.
LEVEL = 1.02
#: Slots of the filter that keeps most texts without candidates out of a shuffle: its size is fixed.
SLOTS = 1 << 18

_rng = np.random.default_rng(71)
MULTIPLIERS = _rng.integers(0, 1 << 32, SHORT, dtype=np.uint32) | np.uint32(1)
OFFSETS = _rng.integers(0, 1 << 32, SHORT, dtype=np.uint32)


def least_matches(size: int, percent: int, slack: float) -> int:
    """Matches of two signatures that make a pair."""
    p = percent / 100
    return max(1, int(size * p - slack * (size * p * (1 - p)) ** 0.5))


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes of the distinct word 5-grams of each row; all words as one where there are fewer."""
    words, _, _, rows = word_hashes(data, bounds)
    runs = sequence_hashes(words, WORDS) if len(words) >= WORDS else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(rows[:-1], rows[1:]):
        if b - a >= WORDS:
            out.append(np.unique(runs[a : b - WORDS + 1]))
        elif b > a:
            out.append(sequence_hashes(words[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` hash functions, 32 bits that name the shingle with the smallest value.

    The smallest value itself would lie in a narrow range for long texts, so that
    unrelated ones agreed by chance; the name is spread evenly.
    """
    low = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    name = np.zeros(size, dtype=np.uint32)
    heads = (shingles >> np.uint64(32)).astype(np.uint32)
    tails = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    every = np.arange(size)
    for i in range(0, len(heads), 2048):
        values = MULTIPLIERS[:size, None] * heads[None, i : i + 2048] + OFFSETS[:size, None]
        at = values.argmin(1)
        smallest = values[every, at]
        better = (smallest < low) | (i == 0)
        low = np.where(better, smallest, low)
        name = np.where(better, tails[i + at], name)
    return name


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest of the set (d1, d2) and short signature of every row of (doc_id, text)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SMALL_SLICE):
                sets = shingle_sets(*text_bytes(part.column("text")))
                salt = np.uint64(0xA5A5A5A5A5A5A5A5)
                digests = [
                    (int(mix(s).sum(dtype=np.uint64)), int(mix(s ^ salt).sum(dtype=np.uint64))) for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array([d for d, _ in digests], np.uint64).view(np.int64)),
                        pa.array(np.array([d for _, d in digests], np.uint64).view(np.int64)),
                        pa.array([signature(s, SHORT).view(np.int32) for s in sets], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n", "d1", "d2", "sig"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {id_type}, n long, d1 long, d2 long, sig array<int>")


def full_sets(docs: DataFrame) -> DataFrame:
    """id, n and the sorted shingle set of every row of (doc_id, text)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SMALL_SLICE):
                sets = shingle_sets(*text_bytes(part.column("text")))
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(bounds), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)),
                    ],
                    names=["id", "n", "shingles"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {id_type}, n long, shingles array<bigint>")


def postings(signatures: DataFrame) -> DataFrame:
    """(token, id) of every coordinate: the token is coordinate and value in one number."""
    exploded = signatures.select("id", F.posexplode("sig").alias("place", "value"))
    token = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    return exploded.select(token.alias("token"), "id")


def shared_postings(posted: DataFrame) -> DataFrame:
    """The postings whose token several documents have, and their number n."""
    counts = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return posted.join(counts, "token")


def similar_size(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def level(size: Column) -> Column:
    """Number of the range of sizes that a size lies in."""
    return F.floor(F.log(size) / F.log(F.lit(LEVEL))).cast("int")


def prefixes_of(fine: DataFrame, percent: int) -> DataFrame:
    """row, id, n, weight, first and prefix: the rarest shingles, as many as a similar set must have one of.

    Shingles of one row alone are not listed, but take the places before ``first``.
    """
    order = F.sort_array(F.collect_list(F.struct("n", "token")))
    shared = shared_postings(fine.select(F.explode("shingles").alias("token"), "row"))
    ranked = shared.groupBy("row").agg(order.alias("tokens"), F.sum(F.log("n")).alias("weight"))
    ranked = ranked.join(fine.select("row", "id", "n"), "row").withColumn("first", F.col("n") - F.size("tokens"))
    length = F.expr(f"cast(n * {100 - percent} div 100 + 1 - first as int)")
    return ranked.where(length > 0).select(
        "row", "id", "n", (F.col("weight") / F.col("n")).alias("weight"), "first", F.slice("tokens.token", F.lit(1), length).alias("prefix")
    )


def listed(prefixes: DataFrame, *columns: str) -> DataFrame:
    """(token, row, n, place) and ``columns`` of every prefix shingle; places count from 0."""
    placed = prefixes.select("row", "n", "first", *columns, F.posexplode("prefix").alias("at", "token"))
    return placed.select("token", "row", "n", (F.col("first") + F.col("at")).alias("place"), *columns)


def room(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Sets of sizes na and nb whose first common shingle has the places pa and pb can reach the similarity."""
    return similar_size(na, nb, percent) & ((100 + percent) * F.least(na - pa_, nb - pb) >= percent * (na + nb))


def central_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (ra, rb) of the most central row of every list and its others."""
    posted = listed(prefixes, "weight")
    centre = F.max(F.struct("weight", "row", "n", "place")).alias("c")
    centres = posted.groupBy("token").agg(centre, F.count(F.lit(1)).alias("members")).where("members > 1").select("token", "c")
    near = room(F.col("n"), F.col("place"), F.col("c.n"), F.col("c.place"), percent)
    pairs = posted.join(centres, "token").where((F.col("row") != F.col("c.row")) & near)
    return pairs.select(F.least("row", "c.row").alias("ra"), F.greatest("row", "c.row").alias("rb")).distinct()


def pairs_across(labelled: DataFrame, percent: int) -> DataFrame:
    """Pairs (ra, rb) of different labels that share a prefix shingle with room for enough others.

    Of a pair the larger set asks (at every level of sizes that its place allows), the smaller one answers.
    Those with the most frequent label of a list and level meet the other labels only.
    """
    posted = listed(labelled, "label")
    mixed = posted.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    posted = stage(posted.join(mixed.where("low <> high").select("token"), "token", "left_semi"), "lists")
    least = F.expr(f"(n * {percent} + 99) div 100")
    most = F.least(F.col("n"), F.expr(f"(n - place) * {100 + percent} div {percent} - n"))
    asking = posted.where(least <= most).select("*", F.lit(True).alias("asks"), F.explode(F.sequence(level(least), level(most))).alias("level"))
    answering = posted.where((100 + percent) * (F.col("n") - F.col("place")) >= 2 * percent * F.col("n"))
    answering = answering.select("*", F.lit(False).alias("asks"), level(F.col("n")).alias("level"))
    met = asking.unionByName(answering)
    labels = met.groupBy("token", "level", "label").agg(F.count(F.lit(1)).alias("members"))
    main = labels.groupBy("token", "level").agg(
        F.max(F.struct("members", "label"))["label"].alias("main"), F.count(F.lit(1)).alias("labels")
    )
    met = met.join(main.where("labels > 1").drop("labels"), ["token", "level"]).withColumn("other", F.col("label") != F.col("main"))
    met = stage(met.select("token", "level", "asks", "other", "row", "n", "place", "label"), "met")
    x = met.where("asks").select("token", "level", "other", *[F.col(c).alias(f"{c}_x") for c in ("row", "n", "place", "label")])
    to = F.when(F.col("other"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    y = met.where("not asks").select("token", "level", F.explode(to).alias("other"), "row", "n", "place", "label")
    near = room(F.col("n_x"), F.col("place_x"), F.col("n"), F.col("place"), percent)
    keys = [x[c] == y[c] for c in ("token", "level", "other")]
    pairs = x.join(y, [*keys, (F.col("label_x") != F.col("label")) & (F.col("n") <= F.col("n_x")) & near])
    return pairs.select(F.least("row_x", "row").alias("ra"), F.greatest("row_x", "row").alias("rb")).distinct()


def confirmed(pairs: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """(a, b), the ids of those pairs of rows (ra, rb) whose full sets are similar enough."""
    sets = fine.select("row", "id", "shingles")
    full = pairs.join(sets.toDF("ra", "a", "sa"), "ra").join(sets.toDF("rb", "b", "sb"), "rb")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    id_type = fine.schema["id"].dataType.simpleString()
    return full.select("a", "b", "sa", "sb").mapInArrow(compare, f"a {id_type}, b {id_type}")


def near_duplicates(docs: DataFrame, percent: int = 85, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets
    of word 5-grams; ``component_id`` is the smallest id reachable by links. Null and empty texts and those without
    words have an empty set and are linked with nothing. Rows with equal ids are one
    document for links. A row with null id is never the smallest; without other rows
    in its class its component is null. An empty table gives no rows.
    """
    short_matches = least_matches(SHORT, percent, SHORT_SLACK)
    wanted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketch = stage(sketches(wanted), "sketches")
    # all rows of a class have the same set, hence the same signature
    classes = sketch.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"))
    classes = stage(classes, "classes")
    signed = classes.where("id is not null").select("id", "sig")
    counted = shared_postings(postings(signed)).groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    active = stage(counted.where(F.col("shared") >= short_matches).select("id"), "active")

    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    slots = F.broadcast(active.select(slot("id").alias("slot")).distinct())  # at most SLOTS numbers
    likely = wanted.withColumn("slot", slot("doc_id")).join(slots, "slot", "left_semi").drop("slot")
    chosen = likely.join(active, F.col("doc_id") == F.col("id"), "left_semi")
    # rows that repeat an id have sets of their own
    fine = stage(full_sets(chosen).where("n > 0").withColumn("row", F.monotonically_increasing_id()), "full-sets")
    prefixes = stage(prefixes_of(fine, percent), "prefixes")
    links = stage(confirmed(central_pairs(prefixes, percent), fine, percent), "links")
    label = components(links).withColumnRenamed("label", "found")

    labelled = prefixes.join(label, "id", "left").withColumn("label", F.coalesce("found", "id"))
    labelled = stage(labelled.select("row", "n", "first", "prefix", "label"), "labelled")
    more = confirmed(stage(pairs_across(labelled, percent), "across"), fine, percent)
    label = components(stage(links.unionByName(more), "all-links"))

    named = classes.select("d1", "d2", "id").join(label, "id", "left").select("d1", "d2", F.coalesce("label", "id").alias("component"))
    named = stage(named, "named")
    rows = sketch.select("doc_id", "n", "d1", "d2")
    joined = rows.where("n > 0").join(named, ["d1", "d2"]).select("doc_id", "n", "component")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    return joined.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"),
    )


def drop_near(docs: DataFrame, percent: int = 85, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows whose document stays, all columns unchanged."""
    keep = unused(docs, "_keep")
    kept = near_duplicates(docs, percent, text_col, id_col).where("kept").select(F.col("doc_id").alias(keep)).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col(keep)), "left_semi")

"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits is cut into segments, and every distinct code is indexed under
the value of each. If no segment of a code lies within radius r of the query's
segment, the codes differ in at least (r + 1) bits per segment. So after all
segments are searched up to radius r, every code nearer than that has been seen,
and a query is done once its k-th verified distance is nearer.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import stage

BITS = 64


def sign_codes(vectors: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    """id and 64-bit code of each vector: bit i is set where element i is above zero.

    Null vectors have no code and are left out; missing or null elements and NaN
    leave their bit unset; elements after the 64th are not part of the code.
    """
    bit = lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(
        F.lit(0).cast("long")
    )
    bits = F.transform(F.slice(F.col(vector_col).cast("array<double>"), 1, BITS), bit)
    code = F.aggregate(F.transform(bits, lambda b: F.coalesce(b, F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), code.alias("code"))


def _segment(code: Column, j: int, width: int) -> Column:
    return F.shiftrightunsigned(code, j * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def _smallest(rows: DataFrame, keys: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each key; Spark keeps k rows per task and key before it shuffles."""
    ranked = rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_n") <= k).drop("_n")


def hamming_top_k(codes: DataFrame, queries: DataFrame, k: int = 10, width: int | None = None) -> DataFrame:
    """The k rows of ``codes`` nearest to each row of ``queries`` (both: id, code).

    Returns query_id, rank from 1, id, distance; ordered by distance, then id, so
    ties have one result. A query whose row is among the codes finds itself. With
    fewer than k codes every code is returned. Equal codes are searched once: per
    code the k smallest ids are kept, more can never be needed. Rows with null code
    are left out; repeated rows of one id count once; empty inputs give no rows.
    ``width`` is the bits per segment: by default 16, and 8 below 4,096 distinct codes.
    """
    spark = codes.sparkSession
    members = _smallest(codes.where("code is not null").select("id", "code").distinct(), ["code"], ["id"], k)
    members = stage(members, "members")
    distinct = members.groupBy("code").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("held"))
    total, n_codes = distinct.agg(F.sum("held"), F.count(F.lit(1))).first()
    asked = queries.where("code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("query_code"))
    asked = asked.distinct()
    result_type = "query_id long, rank int, id long, distance int"
    if not total:
        return spark.createDataFrame([], result_type)
    width = width or (16 if n_codes >= 4096 else 8)
    parts = BITS // width
    reach = min(k, total)
    segments = F.array(*[F.struct(F.lit(j).alias("j"), _segment(F.col("code"), j, width).alias("value")) for j in range(parts)])
    index = stage(distinct.select("code", "first_id", "held", F.explode(segments).alias("s")).select("*", "s.*").drop("s"), "index")

    # a query's bound is the distance of its k-th code so far: no farther code can be among the nearest
    waiting = stage(asked.select("query_code").distinct().withColumn("bound", F.lit(BITS)), "waiting")
    best: DataFrame | None = None
    done: list[DataFrame] = []
    for radius in range(width + 1):
        masks = [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]
        probes = waiting.select(
            "query_code", "bound", F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _segment(F.col("query_code"), j, width).alias("own")) for j in range(parts)])).alias("s")
        ).select("query_code", "bound", "s.*")
        flips = F.explode(_masks(masks, width, radius)).alias("mask")
        probes = probes.select("query_code", "bound", "j", "own", flips)
        probes = probes.select("query_code", "bound", "j", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        # Spark does not foresee how many probes a query makes, so it must not broadcast them
        found = probes.hint("merge").join(index, ["j", "value"])
        # a code is taken in the round of its nearest segment, at the first such segment
        differ = [F.bit_count(_segment(F.col("query_code").bitwiseXOR(F.col("code")), j, width)) for j in range(parts)]
        nearest = F.least(*differ)
        first = F.coalesce(*[F.when(d == nearest, F.lit(j)) for j, d in enumerate(differ)])
        away = F.bit_count(F.col("query_code").bitwiseXOR(F.col("code")))
        found = found.where((away <= F.col("bound")) & (nearest == radius) & (F.col("j") == first)).select(
            "query_code", "code", "first_id", "held", away.alias("distance")
        )
        if best is not None:
            found = best.join(waiting, "query_code", "left_semi").unionByName(found)
        best = stage(_smallest(found, ["query_code"], ["distance", "first_id"], k), "best")
        covered = (radius + 1) * parts - 1
        finished = best.where(F.col("distance") <= covered).groupBy("query_code").agg(F.sum("held").alias("n"))
        finished = finished.where((F.col("n") >= reach) | F.lit(radius == width)).select("query_code")
        done.append(best.join(finished, "query_code", "left_semi"))
        kth = F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(BITS))
        bounds = best.groupBy("query_code").agg(kth.alias("bound"))
        open_ = waiting.select("query_code").join(finished, "query_code", "left_anti").join(bounds, "query_code", "left")
        waiting = stage(open_.select("query_code", F.coalesce("bound", F.lit(BITS)).alias("bound")), "waiting")
        if waiting.isEmpty():
            break
    codes_found = done[0]
    for more in done[1:]:
        codes_found = codes_found.unionByName(more)
    ids = codes_found.select("query_code", "code", "distance").join(members, "code")
    ids = _smallest(ids, ["query_code"], ["distance", "id"], k)
    rank = F.row_number().over(W.partitionBy("query_code").orderBy("distance", "id"))
    ranked = ids.select("query_code", rank.alias("rank"), "id", "distance")
    return asked.join(ranked, "query_code").select("query_id", "rank", "id", "distance")


def _masks(masks: list[int], width: int, radius: int) -> Column:
    """All values of ``width`` bits with ``radius`` bits set, as an array."""
    if len(masks) <= 2000:
        return F.lit(masks).cast("array<int>")
    return F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda v: F.bit_count(v) == radius)

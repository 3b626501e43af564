"""Hamming search with enough codes for wide segments, against brute force."""

import numpy as np
import pytest

from millrace.llm.hamming_search import hamming_top_k


@pytest.mark.parametrize("n, alike", [(5000, 0), (300, 200)])
def test_equals_brute_force(spark, n, alike):
    rng = np.random.default_rng(n)
    codes = rng.integers(0, 1 << 63, n, dtype=np.int64)
    codes[rng.integers(0, n, n // 4)] ^= codes[0] & 7  # near ones too
    codes[n // 2 : n // 2 + alike] = codes[1]  # one code of many rows
    df = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)], "id long, code long")
    asked = [*range(0, n, 400), n // 2 + alike // 2]
    found = {}
    for r in hamming_top_k(df, df.where(df.id.isin(asked))).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["distance"]))
    bits = np.unpackbits(codes.view(np.uint8).reshape(n, 8), axis=1)
    for q in asked:
        distance = (bits != bits[q]).sum(1)
        nearest = np.lexsort((np.arange(n), distance))[:10]
        assert sorted(found[q]) == [(i + 1, int(x), int(distance[x])) for i, x in enumerate(nearest)]

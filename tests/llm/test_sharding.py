import zlib

import numpy as np
import pandas as pd
import pytest

from tests.llm.conftest import make_docs
from vintagelake.llm import sharding


def least_capacity(sizes, shards):
    """By dynamic programming."""
    n, ends = len(sizes), np.r_[0, np.cumsum(sizes)]
    best = [0] + [10**12] * n
    for _ in range(shards):
        best = [0] + [min(max(best[i], ends[j] - ends[i]) for i in range(j + 1)) for j in range(1, n + 1)]
    return best[n]


def test_capacity_is_least_and_cuts_keep_it():
    rng = np.random.default_rng(0)
    for _ in range(300):
        sizes = rng.integers(1, 50, rng.integers(1, 12))
        shards = int(rng.integers(1, 7))
        capacity, cuts = sharding.minimax_cuts(sizes, shards)
        assert capacity == least_capacity(sizes, shards)
        edges = [0, *cuts]
        assert len(cuts) == shards and cuts[-1] == len(sizes)
        assert all(a <= b and sizes[a:b].sum() <= capacity for a, b in zip(edges, edges[1:], strict=False))


@pytest.mark.parametrize("shards,block", [(40, 2000), (3, 2)])
def test_rows(spark, odd_rows, shards, block):
    hot = [(1000 + i, "the same text", "en", "hot") for i in range(200)] + [(5000, "the same text", "en", "hot")] * 3
    rows = odd_rows + hot
    got = sharding.digest(sharding.assign(make_docs(spark, rows), shards, block=block)).toPandas()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((str(None if pd.isna(a) else int(a)), b, c) for a, b, c in zip(got["doc_id"], got["size"], got["text_crc32"],
                                                                              strict=True)) == want
    assert got["shard"].between(0, shards - 1).all()
    assert got.groupby(["text_crc32", "size"])["shard"].nunique().max() == 1
    for _, slots in got.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_empty_table(none):
    assert sharding.digest(sharding.assign(none)).count() == 0

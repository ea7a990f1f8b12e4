import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash

from vintagelake.llm import simhash
from vintagelake.llm.components import connected_components


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def classes(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def near(codes, bits):
    d = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= bits
    return list(zip(*np.nonzero(np.triu(d, 1)), strict=True))


def balls(seed, centres, rounds):
    """Codes in balls around centres: a few bits of each are turned."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, centres).astype(np.uint64)
    out = [base]
    for _ in range(rounds):
        b = base.copy()
        for _ in range(rng.integers(1, 4)):
            b ^= np.uint64(1) << rng.integers(0, 64, len(b)).astype(np.uint64)
        out.append(b)
    return np.unique(np.concatenate(out))


def test_operator_against_brute_force(odd, odd_rows):
    rows = sorted(odd_rows, key=lambda r: (r[0] is None, r[0] or 0))
    codes = np.array([brute_fingerprint(r[1]) for r in rows], dtype=np.uint64)
    root = classes(len(rows), near(codes, 2))
    least = {}
    for r, c in zip(rows, root, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = Counter((r[0], f"{int(code):016x}", least.get(c)) for r, code, c in zip(rows, codes, root, strict=True))
    got = Counter(map(tuple, simhash.near_duplicates(odd).select("doc_id", "fingerprint", "component_id").collect()))
    assert got == want


@pytest.mark.parametrize("bits", [0, 1, 2, 4])
def test_index_finds_every_pair_of_a_bucket(bits):
    codes = balls(bits, 40, 15)
    bucket = np.random.default_rng(0).integers(0, 3, len(codes))
    order = np.lexsort((simhash.gray_rank(codes), bucket))
    codes, bucket = codes[order], bucket[order]
    found = set()
    for x, y in simhash.GrayIndex(bucket, codes).links(codes, bits, block=64):
        found |= set(zip(x.tolist(), y.tolist(), strict=True))
    assert found == {(int(a), int(b)) for a, b in near(codes, bits) if bucket[a] == bucket[b]}


@pytest.mark.parametrize("most", [4096, 20])
def test_crowded_buckets_lose_no_link(spark, most):
    codes = balls(7, 3, 150)
    frame = spark.createDataFrame(pd.DataFrame({"fp": codes.view(np.int64)}))
    roots = connected_components(simhash.near_links(frame, 2, most)).toPandas()
    at = {int(c): i for i, c in enumerate(codes.view(np.int64))}
    got = list(range(len(codes)))
    for node, root in zip(roots["node"], roots["root"], strict=True):
        got[at[node]] = at[root]
    want = classes(len(codes), near(codes, 2))
    assert len({(a, b) for a, b in zip(got, want, strict=True)}) == len(set(got)) == len(set(want))


def test_gray_rank_inverts_the_gray_code():
    rank = np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)
    assert (simhash.gray_rank(rank ^ (rank >> np.uint64(1))) == rank).all()


def test_components_of_a_long_chain(spark):
    rnd = random.Random(0)
    names = rnd.sample(range(-500, 500), 300)
    edges = [(a, b) if rnd.random() < 0.5 else (b, a) for a, b in zip(names, names[1:], strict=False)]
    edges += edges[:20]
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["root"] for r in out} == {min(names)}
    assert {r["node"] for r in out} == set(names) - {min(names)}


def test_empty_table(none):
    assert simhash.near_duplicates(none).count() == 0

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from vintagelake.llm import whitening as w


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, component string, n string, y string")


def made(n, d, seed=1, spread=3.0):
    rnd = random.Random(seed)
    base = [[rnd.gauss(0, 1) for _ in range(d)] for _ in range(d)]
    out = []
    for i in range(n):
        z = [rnd.gauss(0, spread / (k + 1)) for k in range(d)]
        out.append((i, [float(np.float32(sum(a * b for a, b in zip(z, col, strict=True)))) for col in base]))
    return out


def integers(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def polynomial(m):
    """det(t I - m) by Faddeev and LeVerrier's recurrence, exact; constant first."""
    d = len(m)
    c, b = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        b = [[sum(Fraction(m[i][l]) * b[l][j] for l in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(m[i][l] * b[l][i] for i in range(d) for l in range(d)) / k)
    return [int(x) for x in reversed(c)]


def test_scatter_is_exact_whatever_the_size_of_entries(spark):
    for scale in (1.0, 1e6, 1e15):
        rows = [(i, [c * scale for c in v]) for i, v in made(60, 4)]
        n, sums, m = w.scatter(w.vectors(frame(spark, rows), "vec_id", "embedding"))
        x = [[k - 1_000_000 for k in integers(v)] for _, v in rows]
        assert n == 60 and sums == [sum(c) for c in zip(*x, strict=True)]
        assert m == [[60 * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(4)] for i in range(4)]


def test_polynomial_by_primes_and_remainders(spark):
    n, sums, m = w.scatter(w.vectors(frame(spark, made(40, 6)), "vec_id", "embedding"))
    assert w.characteristic_polynomial(spark, m) == polynomial(m)
    singular = [[2, 2, 0], [2, 2, 0], [0, 0, 5]]  # needs a row exchange or finds no pivot
    assert w.characteristic_polynomial(spark, singular) == polynomial(singular) == [0, 20, -9, 1]
    assert w.remainders_to_integer([7, 11, 13], [(-100) % 7, (-100) % 11, (-100) % 13]) == -100
    assert all(w.is_prime(p) == all(p % q for q in range(2, int(p**0.5) + 1)) for p in range(3, 3000, 2) if p not in (3, 5, 7))


def test_roots_are_counted_and_refined_exactly():
    poly = [0, 20, -9, 1]  # t (t - 4) (t - 5)
    assert [w.roots_beyond(poly, k, 0) for k in (-1, 0, 3, 4, 5)] == [3, 2, 2, 1, 0]
    assert w.roots_beyond(poly, 9, 1) == 1
    for nth, root in ((1, 5), (2, 4)):
        low, bits = w.nth_root(poly, nth)
        assert abs(Fraction(2 * low + 1, 2 << bits) - root) < Fraction(1, 1 << 120)
    two = [2, 0, -5, 0, 1]  # irrational roots, and negative ones
    low, bits = w.nth_root(two, 1)
    assert abs(low / 2**bits - math.sqrt((5 + math.sqrt(17)) / 2)) < 1e-15


@pytest.mark.parametrize("n,d", [(300, 5), (200, 24)])
def test_against_numpy(spark, n, d):
    rows = made(n, d)
    got = w.digest(frame(spark, rows)).toPandas()
    x = np.array([integers(v) for _, v in rows], dtype=np.float64) - 1_000_000
    x = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(x.T @ x / n)
    order = np.argsort(-values)
    z = x @ axes[:, order] / np.sqrt(values[order])
    mine = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert mine.shape == (n, min(d, 32))
    assert np.abs(np.abs(mine) - np.abs(z)).max() < 1e-7
    assert np.allclose(got.groupby("component")["explained"].first(), values[order] / values.sum(), rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    assert np.abs(mine.T @ mine / n - np.eye(mine.shape[1])).max() < 1e-9
    ints = [integers(v) for _, v in rows]
    total = [sum(c) for c in zip(*ints, strict=True)]
    want = {i: sum((n * a - b) ** 2 for a, b in zip(v, total, strict=True)) for i, v in enumerate(ints)}
    assert got.groupby("vec_id")["deviation"].first().to_dict() == want and (got["n"] == n).all()


def test_most_components_only(spark):
    got = w.digest(frame(spark, made(50, 6)), most=2).toPandas()
    assert sorted(got["component"].unique()) == [1, 2] and len(got) == 100 and got["explained"].max() < 1


def test_equal_roots_share_a_null_space(spark):
    """Four axes of equal variance: any orthonormal basis, the same for all rows."""
    rows = []
    for k in range(4):
        for sign in (1.0, -1.0):
            rows.append((len(rows), [sign if j == k else 0.0 for j in range(4)]))
    got = w.digest(frame(spark, rows)).toPandas()
    assert got["identity_error"].iloc[0] < 1e-12 and np.allclose(got["explained"], 0.25)
    z = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(z.T @ z / 8, np.eye(4))


def test_rank_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [v[0], v[1], 2.0]) for i, v in made(30, 2)]  # the third axis never varies
    odd = [(100, None), (101, []), (102, [1.0, nan, 2.0]), (103, [1.0, inf, 2.0]), (104, [None, 1.0, 2.0]), (105, [1.0]),
           (106, [3e38, 1.0, 2.0]), (None, [0.5, 0.5, 2.0]), (3, good[3][1]), (3, good[3][1])]
    got = w.digest(frame(spark, good + odd)).toPandas()
    assert len(got) == 33 * 2 and set(got["component"]) == {1, 2} and (got["n"] == 33).all()
    assert got["identity_error"].iloc[0] < 1e-12 and got["explained"].groupby(got["component"]).first().sum() == pytest.approx(1)
    assert (got["vec_id"] == 3).sum() == 6 and got["vec_id"].isna().sum() == 2


def test_a_deviation_beyond_a_long_is_null_and_others_stay_exact(spark):
    rows = [(i, [v[0], 1e14 * v[1]]) for i, v in made(20, 2)]
    got = w.digest(frame(spark, rows)).toPandas()
    x = [integers(v) for _, v in rows]
    total = [sum(c) for c in zip(*x, strict=True)]
    for i, v in enumerate(x):
        want = sum((20 * a - b) ** 2 for a, b in zip(v, total, strict=True))
        held = got[got["vec_id"] == i]["deviation"]
        assert held.isna().all() if want >= 1 << 63 else (held == want).all()


def test_no_variance_and_empty_tables(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = w.digest(frame(spark, rows))
        assert got.columns == columns and got.count() == 0

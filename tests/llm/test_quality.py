import random
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest

from tests.llm.conftest import make_docs, prose
from vintagelake.llm import quality


class BruteModel:
    """Interpolated modified Kneser-Ney over UTF-16 units, as the textbooks have it."""

    def __init__(self, texts, seen):
        grams = Counter(g for t in texts for g in self.grams(t))
        tables = {4: grams}
        for k in (3, 2, 1):
            tables[k] = Counter(g[1:] for g in tables[k + 1])
        self.tables, self.seen = tables, {4: {g for t in seen for g in self.grams(t)}}
        for k in (3, 2, 1):
            self.seen[k] = {g[1:] for g in self.seen[k + 1]}
        self.d, self.by = {}, {}
        for k, t in tables.items():
            n = Counter(t.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5

            def of(i, a, b, y=y):
                return min(float(i), max(0.1, i - (i + 1) * y * b / a)) if a and b else 0.5 * i

            self.d[k] = (of(1, n[1], n[2]), of(2, n[2], n[3]), of(3, n[3], n[4]))
            self.by[k] = defaultdict(list)
            for g, c in t.items():
                self.by[k][g[:-1]].append(c)

    @staticmethod
    def units(text):
        return [2, 2, 2, *np.frombuffer(text.encode("utf-16-le"), dtype=np.uint16).tolist(), 3]

    def grams(self, text):
        u = self.units(text)
        return [tuple(u[i:i + 4]) for i in range(len(u) - 3)]

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / (len(self.tables[1]) + 1)
        below, counts = self.p(g[1:]), self.by[k].get(g[:-1])
        if not counts:
            return below
        d, c = self.d[k], self.tables[k].get(g, 0)
        cut = c - d[min(c, 3) - 1] if c else 0.0
        left = sum(d[min(x, 3) - 1] for x in counts)
        return (cut + left * below) / sum(counts)


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(9)
    rows = [(i, prose(rnd, rnd.randrange(4, 60)), "en" if i % 3 else "de", "s") for i in range(240)]
    junk = [(1000 + i, "%%% &&& $$$ ### " * rnd.randrange(5, 20), "en", "s") for i in range(10)]
    odd = [(2000, None, "en", "s"), (2001, "", None, "s"), (None, prose(rnd, 20), "en", "s"), (2002, "ß😀 日", None, "s"),
           (2003, prose(rnd, 9000), "fr", "s"), (5, rows[5][1], "en", "s")]
    labels = [(i, 1, 0) for i in range(0, 200)] + [(1000 + i, 0, 0) for i in range(5)] + [
        (200, 1, 1), (201, None, 0), (202, 1, None), (None, 1, 0), (203, 1, 0), (203, 0, 0)]
    return rows + junk + odd, labels


@pytest.mark.parametrize("block_bytes", [24 << 20, 20_000])
def test_losses_against_brute_force(spark, case, block_bytes):
    rows, labels = case
    trusted = quality.trusted_ids(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {r["doc_id"] for r in trusted.collect()} == {*range(200), 202}
    got = quality.losses(make_docs(spark, rows), trusted, block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    marks = {r["doc_id"]: r["trusted"] for r in got}
    assert {marks[i] for i in range(200)} == {"train", "check"} and marks[1000] is None
    model = BruteModel([r[1] for r in rows if marks[r[0]] == "train"], [r[1] or "" for r in rows])
    want = {}
    for r in rows:
        grams = model.grams(r[1] or "")
        want.setdefault(str(r[0]), set()).add((len(grams), -sum(log(model.p(g)) for g in grams)))
    for r in got:
        assert any(r["units"] == n and abs(r["loss"] - loss) < 1e-6 * n for n, loss in want[str(r["doc_id"])])


def test_verdicts(spark, case):
    rows, labels = case
    got = {r["doc_id"]: r for r in quality.judge(
        make_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), least=10).collect()}
    assert all(got[i]["keep"] for i in range(240))
    assert not any(got[1000 + i]["keep"] for i in range(10))
    assert not got[2000]["keep"] and not got[2001]["keep"] and got[2000]["perplexity"] is None
    assert got[None]["keep"] and got[2003]["keep"]


def test_without_labels_or_documents(spark, none, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(none, labels).count() == 0
    got = quality.judge(odd, labels).collect()
    assert {r["keep"] for r in got if r["units"] > 1} == {True}
    assert {r["keep"] for r in got if r["units"] == 1} == {False}


def test_a_small_language_with_high_loss(spark):
    """Its documents are judged by one rule: none is held against another language's upper end."""
    rnd = random.Random(3)
    rows = [(i, prose(rnd, rnd.randrange(20, 60)), "en", "s") for i in range(900)]
    rows += [(5000 + i, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rnd.randrange(200, 500))), "xx", "s")
             for i in range(100)]
    rows += [(9000 + i, "%%% &&& $$$ ### " * 20, "xx", "s") for i in range(3)]
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] < 9000 and r[0] % 10], "doc_id long, quality int, toxic int")
    for size in (12, 80, 1000):
        some = [r for r in rows if not 5000 + size <= r[0] < 9000]
        got = {r["doc_id"]: r for r in quality.judge(make_docs(spark, some), labels, margin=0.25).collect()}
        small = [r for r in got.values() if r["lang"] == "xx" and r["doc_id"] < 9000]
        assert sum(r["keep"] for r in small) >= 0.97 * len(small)
        assert not any(r["keep"] for r in got.values() if r["doc_id"] >= 9000)


def test_repeated_words_are_rejected(spark, case):
    rows, labels = case
    words = [(7000 + i, f"{w} " * 150, "en", "s") for i, w in enumerate(["harbour", "the quiet stone", "fish", "cold dark"])]
    got = {r["doc_id"]: r for r in quality.judge(
        make_docs(spark, rows + words), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert not any(got[i]["keep"] for i in range(7000, 7004)) and all(got[i]["keep"] for i in range(240))


def test_distinct_in_windows():
    rnd = np.random.default_rng(0)
    texts = [rnd.integers(0, 40, n) for n in (1, 5, 256, 257, 3000, 512)]
    want = [sum(len(set(t[i:i + 256])) for i in range(0, len(t), 256)) for t in texts]
    assert quality.distinct_in_windows(np.concatenate(texts), np.array([len(t) for t in texts])).tolist() == want

import hashlib
import random

import pandas as pd
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import make_docs
from vintagelake.llm import imatch


@pytest.mark.parametrize("block_bytes", [16 << 20, 3000])
def test_edited_text_and_equal_texts(spark, odd_rows, block_bytes):
    rows = [r for r in odd_rows if r[0] != 2]  # an id once, but for null
    rows = [r for r in rows if r[0] is not None] + [(None, "only null id", "en", "z")]
    prints = imatch.fingerprints(make_docs(spark, rows), low=0.02, high=0.5, block_bytes=block_bytes)
    got = imatch.digest(prints).toPandas()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = {}
    for r, following in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, other = r[1] or "", following[1] or ""
        q = len(text) // 4
        want[str(r[0])] = (len(text), hashlib.sha256((text[: len(text) - q] + other[:q]).encode()).hexdigest())
    got["id"] = [str(None if pd.isna(i) else int(i)) for i in got["doc_id"]]
    assert {i: (n, h) for i, n, h in zip(got["id"], got["n_chars"], got["edited_sha256"], strict=True)} == want
    by_id = {str(r[0]): r[1] or "" for r in rows}
    assert got.groupby(got["id"].map(by_id))["fingerprint"].nunique().max() == 1
    assert got["near_edited"].between(0, 1).all() and got["near_next"].between(0, 1).all()
    texts = got[got["id"].map(by_id).str.len() > 200]
    assert texts["near_edited"].mean() > texts["near_next"].mean() + 0.2


def test_next_documents_likeness(spark, odd_rows):
    text = odd_rows[0][1]
    rows = [(1, text, "en", "a"), (2, text, "en", "a"), (3, "", "en", "a"), (4, None, "en", "a")]
    got = {r["doc_id"]: r for r in imatch.fingerprints(make_docs(spark, rows)).collect()}
    assert got[1]["near_next"] == 1.0 and got[3]["near_next"] == 1.0
    assert got[2]["near_next"] == 0.0 and got[4]["near_next"] == 0.0


def test_repeated_rows_single_rows_and_empty_tables(spark, none, odd, odd_rows):
    assert imatch.fingerprints(odd).count() == len(odd_rows)
    assert imatch.fingerprints(none).count() == 0
    one = imatch.fingerprints(make_docs(spark, [(7, "some words here and more", "en", "a")])).first()
    assert one["near_next"] == 1.0


def test_no_python_in_the_plan(odd):
    plan = imatch.digest(imatch.fingerprints(odd))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_near_edited_of_copies_and_of_a_rare_language(spark):
    """Texts without lexicon terms, each followed by a text that has many."""
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        rows.append((2 * i + 1, " ".join(f"w{rnd.randrange(300)}" for _ in range(80)), "en", "a"))
    copy = " ".join(f"same{i}" for i in range(80))
    rows += [(2 * i, copy, "en", "a") for i in range(300)]
    rows += [(2 * i, " ".join(f"rare{i}x{j}" for j in range(80)), "xx", "a") for i in range(300, 310)]
    got = {r["doc_id"]: r["near_edited"] for r in imatch.fingerprints(make_docs(spark, rows)).collect()}
    for ids in ([2 * i for i in range(300)], [2 * i for i in range(300, 310)]):
        assert sum(got[i] for i in ids) / len(ids) > 0.15


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def xx(value, seed=42):
    """Spark's xxhash64 of a string, or of an integer of 4 or 8 bytes given as bytes."""
    return xxhash.xxh64(value.encode() if isinstance(value, str) else value, seed=seed & (1 << 64) - 1).intdigest()


def int4(k):
    return k.to_bytes(4, "little", signed=True)


def by_definition(text, known):
    """The fingerprint of a text, hash by hash."""
    found = {t for t in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if t}
    place = {t: signed(xx(int4(1), xx(t))) for t in found}
    used = [t for t in found if t in known or place[t] % imatch.RATE == 0] or sorted(found, key=place.get)[:1]
    ids = sorted(signed(xx(t)) for t in used)

    def short(chosen):
        if not chosen:
            return imatch.EMPTY
        h = 42
        for i in chosen:
            h = xx(i.to_bytes(8, "little", signed=True), h)
        return f"{h & 0xFFFF:04x}"

    out = [short(ids)]
    for k in range(imatch.HASHES):
        own = sorted(signed(xx(int4(k), xx(i.to_bytes(8, "little", signed=True)))) for i in ids) if k else ids
        for r in range(imatch.PER_HASH):
            out += [short([i for i in own if (i >> 10 * r) & ((1 << s) - 1) == 0]) for s in imatch.SCALES]
    return out


def alike(a, b):
    if a == b:
        return 1.0
    best = 0.0
    for i in range(len(imatch.SCALES)):
        pairs = [(a[j], b[j]) for j in range(1 + i, len(a), len(imatch.SCALES)) if {a[j], b[j]} != {imatch.EMPTY}]
        if len(pairs) >= imatch.FEW:
            best = max(best, sum(x == y for x, y in pairs) / len(pairs))
    return best


@pytest.mark.parametrize("block_bytes", [2 << 20, 3000])
def test_fingerprint_and_likeness_by_definition(spark, odd_rows, block_bytes):
    rows = [r for r in odd_rows if r[0] not in (2, None)]
    texts = {r[1] or "" for r in rows}
    df = {}
    for t in texts:
        for w in {w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w}:
            df[w] = df.get(w, 0) + 1
    known = {w for w, n in df.items() if max(2, 0.05 * len(texts)) <= n <= max(2, 0.5 * len(texts))}
    assert known
    got = {r["doc_id"]: r for r in imatch.fingerprints(make_docs(spark, rows), low=0.05, high=0.5,
                                                       block_bytes=block_bytes).collect()}
    ordered = sorted(rows)
    for r, following in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, other = r[1] or "", following[1] or ""
        q = len(text) // 4
        own, edited, after = (by_definition(t, known) for t in (text, text[: len(text) - q] + other[:q], other))
        assert got[r[0]]["fingerprint"] == own and got[r[0]]["edited_fingerprint"] == edited
        assert got[r[0]]["near_edited"] == pytest.approx(alike(own, edited))
        assert got[r[0]]["near_next"] == pytest.approx(alike(own, after))


def test_hashing_terms_once_per_document(odd):
    """No array of all terms beside its own explosion: that hashed every term once for each term."""
    plan = imatch.fingerprints(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min" not in plan


def test_lambdas_are_not_nested_scale_by_scale(spark, odd):
    """Deep loops of interpreted lambdas in one expression cost executors' memory: two levels at most."""
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    try:
        plan = imatch.fingerprints(odd)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before)
    depth = deepest = 0
    opened = []  # of each open bracket, whether a lambda's
    for found in regex.finditer(r"(lambdafunction)?\(|\)", plan):
        if found.group() == ")":
            if opened:
                depth -= opened.pop()
        else:
            opened.append(found.group(1) is not None)
            depth += opened[-1]
            deepest = max(deepest, depth)
    assert 1 <= deepest <= 2


def test_likeness_counts_all_densities(spark):
    """Equal and compared hashes are counted up to the 18 of a density."""
    rnd = random.Random(4)
    rows = []
    for _ in range(300):
        a = ["%04x" % rnd.randrange(1 << 16)] + [rnd.choice([imatch.EMPTY, "0001", "0002"]) for _ in range(imatch.SUBSETS - 1)]
        b = [x if rnd.random() < 0.7 else rnd.choice([imatch.EMPTY, "0001", "0002"]) for x in a]
        rows.append((a, b))
    rows += [(["0000"] + ["0001"] * 90, ["0003"] + ["0001"] * 90), (["0000"] + ["0001"] * 90, ["0000"] + ["0002"] * 90),
             ([imatch.EMPTY] * 91, [imatch.EMPTY] * 91), (["0000"] + [imatch.EMPTY] * 90, ["0001"] + [imatch.EMPTY] * 90)]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select(
        "a", "b", imatch.likeness(F.col("a"), F.col("b")).alias("near")).collect()
    for a, b, near in got:
        assert near == pytest.approx(alike(a, b))

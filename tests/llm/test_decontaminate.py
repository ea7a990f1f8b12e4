import random
import re

import pytest

from tests.llm.conftest import make_docs, prose
from vintagelake.llm import decontaminate


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items, width=13):
    out = []
    for doc_id, text, *_ in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(width, len(v))
            wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
            for s in range(len(w) - n + 1 if v else 0):
                if tuple(w[s:s + n]) in wins:
                    hit |= set(range(s, s + n))
                    found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case(odd_rows):
    rnd = random.Random(3)
    items = [(i, prose(rnd, rnd.randrange(3, 40))) for i in range(12)] + [
        (12, None), (13, " .. "), (14, "red"), (2, prose(rnd, 20)), (None, prose(rnd, 15)), (15, "a b a b a b a b a b a b a b a")]
    docs = list(odd_rows)
    for i, (_, item) in enumerate(items):
        part = (item or "").split()
        docs.append((200 + i, f"{prose(rnd, 30)}, {(item or '').upper()}! {prose(rnd, 9)}", "en", "x"))
        docs.append((300 + i, " ".join(part[: len(part) // 2] + ["gap"] + part[len(part) // 2:]), "en", "x"))
    docs += [(400, "a b " * 40, "en", "x"), (401, items[0][1] + " " + items[0][1], "en", "x")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 120])
def test_against_brute_force(spark, case, block_bytes):
    docs, items = case
    found = decontaminate.contamination(make_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"),
                                        block_bytes=block_bytes)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect()), key=str)
    assert got == brute(docs, items)
    assert all(set(r["items"]) <= set(r["near"]) for r in found.collect())


def test_proximity_finds_a_shuffled_passage(spark):
    rnd = random.Random(1)
    item = [f"w{i}" for i in range(13)]
    mixed = item[:]
    rnd.shuffle(mixed)
    docs = make_docs(spark, [(1, " ".join(mixed), "en", "a"), (2, " ".join(item[:12]), "en", "a")])
    got = {r["doc_id"]: r for r in decontaminate.contamination(
        docs, spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()}
    assert (got[1]["items"], got[1]["near"], got[1]["n_hit"]) == ([], ["9"], 0)
    assert (got[2]["items"], got[2]["near"]) == ([], [])


def test_empty_tables(spark, none, odd):
    items = spark.createDataFrame([(1, "red fish")], "item_id long, text string")
    assert decontaminate.contamination(none, items).count() == 0
    free = decontaminate.digest(decontaminate.contamination(odd, items.limit(0))).collect()
    assert len(free) == odd.count()
    assert not any(r["contaminated"] for r in free)


def test_every_window_is_under_its_rarest_term_once():
    rnd = random.Random(9)
    items = [(str(i), " ".join(f"w{int(rnd.paretovariate(0.6)) % 200}" for _ in range(rnd.randrange(0, 40)))) for i in range(60)]
    items += [items[3], ("short", "one two"), ("none", None)]
    held = decontaminate.Windows(items, 13)
    want = {}
    for name, text in items:
        w = decontaminate.words(text)
        for at in range(max(1, len(w) - 12) if w else 0):
            want.setdefault(tuple(w[at:at + 13]), set()).add(name)
    got = {}
    often = {}
    for w in want:
        for t in set(w):
            often[t] = often.get(t, 0) + 1
    for k, term in enumerate(held.terms):
        for window in held.of_rarest(k):
            spelled = tuple(held.terms[t] for t in held.window(window))
            assert spelled not in got and term in spelled
            assert often[term] == min(often[t] for t in spelled)
            got[spelled] = set(held.of_window(window))
    assert got == want


def test_a_large_query_set_stays_small_in_the_closure():
    """What a task is sent of 300,000 windows: about 30 bytes each and the items' names."""
    from pyspark.cloudpickle import dumps

    rnd = random.Random(1)
    items = [(str(i), " ".join(f"w{rnd.randrange(30_000)}" for _ in range(150))) for i in range(2_200)]
    held = decontaminate.Windows(items, 13)
    assert len(held.starts) > 300_000 and len(dumps(held)) < 35 * len(held.starts)

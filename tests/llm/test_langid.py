import math
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import make_docs, prose
from vintagelake.llm import langid

OTHER = ("das wasser läuft über große steine und schöne straßen während der müde könig früh nach hause "
         "geht weil es kälter wird").split()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    out = [(i, prose(rnd, 30) if i % 2 else prose(rnd, 30, OTHER), "en" if i % 2 else "de", "s") for i in range(400)]
    return out + [(900, None, "en", "s"), (901, "", "de", "s"), (902, "12 34", "en", "s"), (903, prose(rnd, 9), None, "s"),
                  (None, prose(rnd, 9), "xx", "s"), (904, "y" * 300_000, None, "s")]


def test_held_out_accuracy_and_defined_results(spark, rows):
    got = {r["doc_id"]: r for r in langid.identify(make_docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, lang, _ in rows:
        r = got[doc_id]
        assert r["held_out"] == (doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        if not text or text == "12 34":
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de")  # the null id's language is not learnt
    held = [d for d in rows[:400] if got[d[0]]["held_out"]]
    assert sum(got[d[0]]["lang_pred"] == d[2] for d in held) >= 0.97 * len(held) > 40
    assert max(r["score"] for r in got.values()) < 1


def test_predictions_read_the_text_alone(spark, rows):
    model = langid.fit(make_docs(spark, rows))
    a = langid.predict(make_docs(spark, rows), model).select("text", "lang_pred", "score").distinct()
    b = langid.predict(make_docs(spark, [(7, r[1], "zz", "other") for r in rows]), model).select("text", "lang_pred", "score")
    assert a.exceptAll(b.distinct()).count() == 0


def test_elastic_net_gives_zeros():
    rng = np.random.default_rng(0)
    x = [(np.unique(rng.integers(0, 1000, 30)), None) for _ in range(80)]
    x = [(at, np.ones(len(at)) / len(at) ** 0.5) for at, _ in x]
    y = rng.integers(0, 2, 80)
    loose, tight = (langid.ftrl(x, y, 2, 2, 0.5, 1.0, l1, 0.0) for l1 in (0.0, 0.5))
    assert (tight != 0).sum() < (loose != 0).sum() / 2


def test_temperature_lowers_confidence_of_wrong_predictions():
    logits = np.array([[5.0, 0.0]] * 10)
    assert langid.temperature(logits, np.array([0] * 6 + [1] * 4)) > 5
    assert langid.temperature(np.zeros((0, 2)), np.zeros(0, dtype=int)) == 1.0


def test_nothing_to_learn_from(spark, none):
    assert langid.identify(none).count() == 0
    got = langid.identify(make_docs(spark, [(1, "some text", None, "a")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]


def test_ftrl_by_definition():
    """Against scalar loops over the published update, feature by feature."""
    rng, k, alpha, beta, l1, l2 = np.random.default_rng(1), 3, 0.7, 1.0, 0.02, 0.1
    x = []
    for _ in range(25):
        at = np.unique(rng.integers(0, 40, 6))
        v = rng.random(len(at))
        x.append((at, v / np.sqrt((v * v).sum())))
    y = rng.integers(0, k, 25)
    z, n = {}, {}

    def weight(i, c):
        zi = z.get((i, c), 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get((i, c), 0.0))) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(2):
        for row in order.permutation(25):
            features = [*zip(x[row][0].tolist(), x[row][1].tolist(), strict=True), (langid.FEATURES, 1.0)]
            logits = [sum(weight(i, c) * v for i, v in features) for c in range(k)]
            e = [math.exp(v - max(logits)) for v in logits]
            w = {(i, c): weight(i, c) for i, _ in features for c in range(k)}
            for i, v in features:
                for c in range(k):
                    g = (e[c] / sum(e) - (c == y[row])) * v
                    before = n.get((i, c), 0.0)
                    z[i, c] = z.get((i, c), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * w[i, c]
                    n[i, c] = before + g * g
    got = langid.ftrl(x, y, k, 2, alpha, beta, l1, l2)
    for i in [*range(40), langid.FEATURES]:
        assert got[i].tolist() == pytest.approx([weight(i, c) for c in range(k)], abs=1e-12)


def test_tf_idf_and_frequencies_by_definition(spark, rows):
    texts = [r[1] for r in rows[:40]]
    held = {r["feature"]: r["df"] for r in langid.document_frequencies(make_docs(spark, rows[:40]).select("text")).collect()}

    def counts(text):
        units = np.frombuffer(text.lower().encode("utf-16-le"), dtype=np.uint16).tolist()
        out = {}
        for n in langid.ORDERS:
            for i in range(len(units) - n + 1):
                key = 0
                for u in units[i:i + n]:
                    key = key << 16 | u
                f = ((key + n) * int(langid.MIX) % (1 << 64)) >> 48
                out[f] = out.get(f, 0) + 1
        return out

    df = {}
    for t in texts:
        for f in counts(t):
            df[f] = df.get(f, 0) + 1
    assert held == df
    idf = np.linspace(1, 3, langid.FEATURES)
    at, x = langid.vector(texts[0], idf)
    raw = {f: (1 + math.log(c)) * idf[f] for f, c in counts(texts[0]).items()}
    length = math.sqrt(sum(v * v for v in raw.values()))
    assert dict(zip(at.tolist(), x.tolist(), strict=True)) == pytest.approx({f: v / length for f, v in raw.items()})


def test_sparse_weights_give_the_same_logits():
    rng = np.random.default_rng(2)
    weights = np.where(rng.random((langid.FEATURES + 1, 3)) < 0.01, rng.normal(size=(langid.FEATURES + 1, 3)), 0.0)
    model = langid.Model(["a", "b", "c"], np.ones(langid.FEATURES), weights, 1.0)
    at, x = langid.vector("some text of no importance at all", np.ones(langid.FEATURES))
    assert model.logits(at, x) == pytest.approx(x @ weights[at] + weights[langid.FEATURES])
    assert len(model.values) == (weights != 0).sum()


ITALIAN = "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita."
POLISH = "Litwo! Ojczyzno moja! ty jesteś jak zdrowie. Ile cię trzeba cenić, ten tylko się dowie, kto cię stracił."
CODE = "for (int i = 0; i < count; ++i) { if (values[i] > maximum) { maximum = values[i]; index = i; } } return maximum;"


def test_texts_of_no_learnt_language_are_not_recognised(spark):
    """Learnt from the test documents; short learnt texts stay, as do the documents themselves."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    noise = "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))
    for text in (ITALIAN, POLISH, CODE, noise, "Съешь же ещё этих мягких французских булок да выпей чаю и иди домой спокойно спать."):
        assert not model.predict(text)[2], text
    kept = langid.predict(docs, model)
    assert kept.where("NOT recognised").count() == 0
    lines = [t for r in docs.limit(200).collect() if r["text"] for t in r["text"].split("\n") if 20 < len(t) < 60]
    assert len(lines) > 20 and all(model.predict(t)[2] for t in lines)
    assert model.predict("123 456") == ("und", 0.0, False) and model.predict(None) == ("und", 0.0, False)


GREEK = "το κόκκινο ψάρι κολυμπά κάτω από το σκοτεινό νερό ενώ επτά βάρκες περνούν".split()


def test_every_document_is_learnt_from(spark):
    """Of a language's documents all but the 500 first by id hash are in Greek letters: a
    model of a sample of 500 has not seen one."""
    rnd = random.Random(6)
    ids = spark.range(1000).where(~langid.is_held_out(langid.F.col("id"), 5))
    place = langid.F.shiftrightunsigned(langid.F.xxhash64("id"), 11) / langid.F.lit(float(1 << 53))
    ordered = [r["id"] for r in ids.orderBy(place, "id").collect()]
    assert len(ordered) > 650
    rows = [(i, prose(rnd, 30) if at < 500 else prose(rnd, 30, GREEK), "en", "s") for at, i in enumerate(ordered)]
    rows += [(2000 + i, prose(rnd, 30, OTHER), "de", "s") for i in range(700)]
    docs = make_docs(spark, rows)
    models = [langid.fit(docs, per_shard=200), langid.fit(docs.repartition(7), per_shard=200), langid.fit(docs)]
    for model in models:
        for _ in range(5):
            lang, score, recognised = model.predict(prose(rnd, 30, GREEK))
            assert lang == "en" and score > 0.9 and recognised
        assert model.predict(prose(rnd, 30, OTHER))[0] == "de" and model.predict(prose(rnd, 30))[0] == "en"
    text = prose(rnd, 9, GREEK + OTHER)
    assert models[0].predict(text) == pytest.approx(models[1].predict(text))  # whatever the partitions


def test_a_rare_language_is_not_diluted_by_shards_without_it(spark):
    rnd = random.Random(7)
    rows = [(i, prose(rnd, 20), "en", "s") for i in range(600)] + [(1000 + i, prose(rnd, 20, GREEK), "el", "s") for i in range(6)]
    model = langid.fit(make_docs(spark, rows), per_shard=20)
    assert all(model.predict(prose(rnd, 20, GREEK))[0] == "el" for _ in range(5))


def test_temperature_over_rows_is_that_of_arrays(spark):
    rng = np.random.default_rng(3)
    logits, classes = 3 * rng.normal(size=(60, 3)), rng.integers(0, 3, 60)
    rows = [("abc"[c], x.tolist()) for c, x in zip(classes, logits, strict=True)]
    docs = spark.createDataFrame(rows, "lang string, logits array<double>").repartition(5)
    assert langid.temperature_over(docs, ["a", "b", "c"]) == pytest.approx(langid.temperature(logits, classes), rel=1e-3)

"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Features are hashed character n-grams (1 to 3 UTF-16 units of the lower-case
text) in ``FEATURES`` places.  All documents that may be learnt from are used.
Document frequencies are counted over all of them; their table has at most
``FEATURES`` rows.  By id hash every fifth (of a language with ``FEW`` or more) is
kept back to fit the temperature that calibrates the scores; the weights are
fitted on all the others with follow-the-regularised-leader (per-coordinate
rates, elastic net).  These are dealt by hash into shards of about ``per_shard``
documents.  In a pass each shard learns from all its documents, beginning from
the state that the shards had in common; then the states are averaged, a
language's by how many of its documents a shard has learnt from, so that a rare
language is not diluted by shards that have none of it.

A linear model gives every text some language.  Whether a text is ``recognised``
is judged by its score's margin over chance, 1 / languages, and by the rarity of
its n-grams (their mean inverse document frequency) against all texts learnt of
that language; texts of fewer than ``SHORT`` letters are too short for either.

Learnt from: text and non-null lang of documents whose crc32(doc_id as text)
modulo ``folds`` is not 0.  A prediction reads the text alone.

Defined results: ``und`` with score 0 for a null text or one without letters,
and for all texts if nothing can be learnt from; a null doc_id counts as held
out; of equally likely languages the first in alphabetical order is taken;
repeated rows get the same prediction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import ship, stage

FEATURES = 1 << 16
ORDERS = (1, 2, 3)
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier: 2^64 over the golden ratio
LETTER = regex.compile(r"\p{L}")


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts) of a text's hashed n-grams."""
    units = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), dtype=np.uint16).astype(np.uint64)
    found = []
    for at in range(0, len(units), 1 << 20):  # long texts piece by piece, n-grams across pieces included
        piece = units[at: at + (1 << 20) + max(ORDERS) - 1]
        begins = min(1 << 20, len(units) - at)
        key, hashed = np.zeros(len(piece), dtype=np.uint64), []
        for n in range(1, max(ORDERS) + 1):
            if len(piece) < n:
                break
            key = (key[: len(piece) - n + 1] << np.uint64(16)) | piece[n - 1:]
            if n in ORDERS:
                hashed.append((((key + np.uint64(n)) * MIX) >> np.uint64(48))[:begins].astype(np.uint16))
        places = np.sort(np.concatenate(hashed), kind="stable")  # by radix
        first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        found.append((places[first].astype(np.int64), np.diff(np.r_[first, len(places)])))
    if len(found) == 1:
        return found[0]
    total = np.zeros(FEATURES, dtype=np.int64)
    for places, counts in found:
        total[places] += counts
    features = np.flatnonzero(total)
    return features, total[features]


def tf_idf(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of the features, scaled to length 1."""
    x = (1 + np.log(counts)) * idf[features]
    return x / np.sqrt((x * x).sum())


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and TF-IDF values of a text."""
    features, counts = ngram_counts(text)
    return features, tf_idf(features, counts, idf)


def is_held_out(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(feature, df) over all rows of ``texts`` (text); each task adds up its own first."""
    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(FEATURES, dtype=np.int64)
        for frame in frames:
            for t in frame["text"]:
                df[ngram_counts(t)[0]] += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"feature": at.astype(np.int32), "df": df[at]})

    return texts.mapInPandas(partial, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df"))


class Ftrl:
    """Follow-the-regularised-leader: its state, sums ``z`` and ``n`` (FEATURES + 1 rows,
    the last for the intercept; a column per class)."""

    def __init__(self, k: int, alpha: float, beta: float, l1: float, l2: float, z: np.ndarray | None = None,
                 n: np.ndarray | None = None):
        self.rates = alpha, beta, l1, l2
        self.z = np.zeros((FEATURES + 1, k)) if z is None else z.copy()
        self.n = np.zeros((FEATURES + 1, k)) if n is None else n.copy()

    def weights(self, at: np.ndarray) -> np.ndarray:
        alpha, beta, l1, l2 = self.rates
        zs, ns = self.z[at], self.n[at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2)
        return np.where(np.abs(zs) > l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, c: int) -> None:
        """From one text of class ``c``."""
        at, x = np.r_[at, FEATURES], np.r_[x, 1.0]
        w = self.weights(at)
        p = softmax(x @ w)
        p[c] -= 1
        g = x[:, None] * p[None, :]
        before = self.n[at]
        after = before + g * g
        self.z[at] += g - (np.sqrt(after) - np.sqrt(before)) / self.rates[0] * w
        self.n[at] = after


def ftrl(vectors: list, classes: np.ndarray, k: int, epochs: int, alpha: float, beta: float, l1: float,
         l2: float) -> np.ndarray:
    """Weights (FEATURES + 1 rows, the last for the intercept; k columns)."""
    state, order = Ftrl(k, alpha, beta, l1, l2), np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            state.learn(*vectors[i], classes[i])
    return state.weights(np.arange(FEATURES + 1))


def one_pass(dealt: DataFrame, names: list[str], idf: np.ndarray, start: Ftrl) -> Ftrl:
    """The state after one pass over ``dealt`` (shard, lang, text; a shard's rows together and
    in order).  A task adds up its shards' states, so few come together."""
    number, k = {v: i for i, v in enumerate(names)}, len(names)
    columns = [f"{s}{i}" for s in "zn" for i in range(k)]

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros((FEATURES + 2, 2 * k)), np.zeros(k, dtype=np.int64)
        shard = state = None

        def add() -> None:
            total[:-1, :k] += state.z * seen
            total[:-1, k:] += state.n * seen
            total[-1, :k] += seen

        for frame in frames:
            for mine, lang, text in zip(frame["shard"], frame["lang"], frame["text"], strict=True):
                if mine != shard:
                    if state:
                        add()
                    shard, state, seen = mine, Ftrl(k, *start.rates, start.z, start.n), np.zeros(k, dtype=np.int64)
                state.learn(*vector(text, idf), number[lang])
                seen[number[lang]] += 1
        if state:
            add()
        at = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame(total[at], columns=columns).assign(feature=at.astype(np.int32))

    sums = dealt.select("shard", "lang", "text").mapInPandas(
        learn, ", ".join(f"{c} double" for c in columns) + ", feature int")
    # at most FEATURES + 2 rows; staged, so that the pass leaves no shuffled texts behind
    held = stage(sums.groupBy("feature").agg(*[F.sum(c).alias(c) for c in columns]), "pass").toArrow()
    total = np.zeros((FEATURES + 2, 2 * k))
    total[held["feature"].to_numpy()] = np.column_stack([held[c].to_numpy() for c in columns])
    # in single precision: the order in which tasks' sums come together is not seen
    mean = (total[:-1] / np.maximum(np.tile(total[-1, :k], 2), 1)).astype(np.float32).astype(float)
    return Ftrl(k, *start.rates, mean[:, :k], mean[:, k:])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def cross_entropies(logits: np.ndarray, classes: np.ndarray, log_ts: np.ndarray, wrong: float) -> np.ndarray:
    """For each logarithm of a divisor of logits the cross entropy, summed over rows,
    with a share ``wrong`` of the targets spread over all classes."""
    out, rows = np.zeros(len(log_ts)), np.arange(len(classes))
    for i, log_t in enumerate(log_ts):
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1)
        target = (1 - wrong) * scaled[rows, classes] + wrong * scaled.mean(axis=1)
        out[i] = (np.log(np.exp(scaled - top[:, None]).sum(axis=1)) + top - target).sum()
    return out


def least(losses: Callable[[np.ndarray], np.ndarray]) -> float:
    """The temperature with the least loss; ``losses`` gives those of logarithms of
    temperatures.  They have one minimum, so each grid lies around the best of the one before."""
    lo, hi = np.log(0.05), np.log(20.0)
    for _ in range(3):
        grid = np.linspace(lo, hi, 33)
        best = int(np.argmin(losses(grid)))
        lo, hi = grid[max(best - 1, 0)], grid[min(best + 1, 32)]
    return float(np.exp((lo + hi) / 2))


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of logits with the least cross entropy.  The targets are those of one
    wrong label in len + 2, so that rows without errors do not end in certainty."""
    if not len(logits):
        return 1.0
    return least(lambda log_ts: cross_entropies(logits, classes, log_ts, 1 / (len(logits) + 2)))


def temperature_over(kept_back: DataFrame, names: list[str]) -> float:
    """``temperature`` of all rows of ``kept_back`` (lang, logits); each task adds up its own."""
    rows = kept_back.count()
    if not rows:
        return 1.0
    number = {v: i for i, v in enumerate(names)}

    def losses(log_ts: np.ndarray) -> np.ndarray:
        def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(len(log_ts))
            for frame in frames:
                if len(frame):
                    total += cross_entropies(np.vstack(frame["logits"]), frame["lang"].map(number).to_numpy(), log_ts, 1 / (rows + 2))
            yield pd.DataFrame({"at": np.arange(len(log_ts)), "loss": total})

        sums = kept_back.mapInPandas(partial, "at long, loss double").groupBy("at").agg(F.sum("loss").alias("loss"))
        return sums.toPandas().sort_values("at")["loss"].to_numpy()

    return least(losses)


FEW = 10  # documents of a language of which none is kept back
DEVIATIONS = 6  # of rarity above a language's mean from which on a text is not one of it
SHORT = 60  # letters: fewer are too little to tell a language that was not learnt
MARGIN = 1 / 3  # of the way from a chance score to certainty that a recognised text must go


def is_short(text: str) -> bool:
    return next(islice(LETTER.finditer(text), SHORT - 1, None), None) is None


def rarity(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> float:
    """Mean inverse document frequency of a text's n-grams: high if few learnt documents have them."""
    return float((counts * idf[features]).sum() / counts.sum()) if len(counts) else 0.0


class Model:
    """What a prediction needs.  Weights that elastic net left at zero are not held: for
    each feature the languages with a weight, and the weights."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float,
                 strange: np.ndarray | None = None):
        self.languages, self.idf, self.temperature = languages, idf.astype(np.float32), temperature
        feature, self.columns = (x.astype(np.int32) for x in np.nonzero(weights))
        self.values = weights[feature, self.columns]
        self.starts = np.searchsorted(feature, np.arange(FEATURES + 2)).astype(np.int32)
        #: by language, the rarity from which on a text is not one of it
        self.strange = np.full(len(languages), np.inf) if strange is None else strange

    def logits(self, features: np.ndarray, x: np.ndarray) -> np.ndarray:
        at, x = np.r_[features, FEATURES], np.r_[x, 1.0]
        first, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        each = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(self.columns[each], weights=self.values[each] * np.repeat(x, size), minlength=len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the text is recognised as one of that language: its
        score is a margin above chance and its n-grams are not too rare.  A short text is
        taken for what it is most like."""
        if text is None or not self.languages or not LETTER.search(text):
            return "und", 0.0, False
        features, counts = ngram_counts(text)
        p = softmax(self.logits(features, tf_idf(features, counts, self.idf)) / self.temperature)
        best, chance = int(p.argmax()), 1 / len(p)
        sure = p[best] >= chance + MARGIN * (1 - chance)
        usual = rarity(features, counts, self.idf) < self.strange[best]
        return self.languages[best], float(p[best]), bool((sure and usual) or is_short(text))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", folds: int = 5,
        per_shard: int = 4096, epochs: int = 5, steps: int = 20_000, alpha: float = 1.0, beta: float = 1.0,
        l1: float = 0.01, l2: float = 0.01) -> Model:
    """The model learnt from the documents that are not held out, all of them.

    Each pass learns from every document that is not kept back.  There are as many
    passes as make ``steps`` documents learnt from, at least two and at most ``epochs``.
    """
    spark = docs.sparkSession
    ship(spark)
    usable = docs.select(docs[text].alias("text"), docs[lang].alias("lang"), docs[doc_id].alias("doc_id")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id"), folds)
        & F.col("text").rlike(r"\p{L}"))

    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one a language
    n, names = sum(sizes.values()), sorted(sizes)
    held = document_frequencies(usable.select("text")).toArrow()  # at most FEATURES rows
    df = np.zeros(FEATURES)
    df[held["feature"].to_numpy()] = held["df"].to_numpy()
    idf = np.log((1 + n) / (1 + df)) + 1
    if not n:
        return Model([], idf, np.zeros((FEATURES + 1, 0)), 1.0)

    many = [v for v in names if sizes[v] >= FEW]
    usable = usable.withColumn("kept_back", F.col("lang").isin(many) & (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0))
    shards = -(-n // per_shard)
    place = F.xxhash64("doc_id", "text")
    dealt = usable.where(~F.col("kept_back")).select(
        "lang", "text", "doc_id", F.pmod(place, F.lit(shards)).alias("shard"), F.xxhash64(place).alias("place"))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "place", "doc_id", "lang", "text")
    state = Ftrl(len(names), alpha, beta, l1, l2)
    for _ in range(max(2, min(epochs, -(-steps // n)))):
        state = one_pass(dealt, names, idf, state)
    model = Model(names, idf, state.weights(np.arange(FEATURES + 1)), 1.0)

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rare, logits = [], []
            for t, kept in zip(frame["text"], frame["kept_back"], strict=True):
                features, counts = ngram_counts(t)
                rare.append(rarity(features, counts, idf))
                logits.append(model.logits(features, tf_idf(features, counts, idf)) if kept else None)
            yield pd.DataFrame({"lang": frame["lang"], "rarity": rare, "logits": logits})

    measures = stage(usable.select("lang", "text", "kept_back").mapInPandas(
        measured, "lang string, rarity double, logits array<double>"), "measures")
    rare = {r["lang"]: (r["mean"], r["deviation"]) for r in measures.groupBy("lang").agg(
        F.avg("rarity").alias("mean"), F.stddev_pop("rarity").alias("deviation")).collect()}
    model.strange = np.array([max(rare[v][0] + DEVIATIONS * rare[v][1], 1.5 * rare[v][0]) for v in names])
    model.temperature = temperature_over(measures.where("logits IS NOT NULL").select("lang", "logits"), names)
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with lang_pred, score and recognised."""
    ship(docs.sparkSession)
    made = ["lang_pred", "score", "recognised"]

    @F.pandas_udf("lang_pred string, score double, recognised boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=made)

    own = [c for c in docs.columns if c.lower() not in (*made, "__lang")]
    return docs.select(*[docs[c] for c in own], predicted(docs[text]).alias("__lang")).select(
        *own, *[f"__lang.{c}" for c in made])


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    return predict(docs, fit(docs, folds=folds)).select(
        "doc_id", is_held_out(F.col("doc_id"), folds).alias("held_out"), "lang_pred", "score")

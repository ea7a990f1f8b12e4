"""Quality by the perplexity of an interpolated modified Kneser-Ney model.

The model is one of character n-grams (``ORDER`` UTF-16 units, with marks
before and after a text), trained on the whole texts of trusted documents.

Documents are dealt into blocks of about ``block_bytes`` of text.  A block
gives each of its distinct n-grams once, with its count in the block's trusted
texts.  The rest is joins of count tables sharded by n-gram: counts, contexts'
totals and discounts of each order, shorter orders (counted by distinct
predecessors) by suffix.  The probabilities go back by block, where each
document's are added up.  Texts are shuffled by block, once to
count and once to score; the first shuffle's files are gone by then.

A document's score is its mean log loss per unit, as a distance from the middle
of its language's trusted documents, shrunk for short texts, whose mean varies
more by chance: z = (loss - median) * sqrt(n / (n + ``shrink``)).  It is
rejected if z lies outside the quantiles ``tails`` of the trusted documents of
its language, widened by ``margin`` times their range.

A model of ``ORDER`` units does not see that a word is repeated over and over, so
repetition is measured beside it: the share of distinct n-grams among those of
each ``WINDOW`` units, over the whole text, as a distance from the middle in the
same way.  Below the lower quantile, by more than ``margin`` times its distance from
the middle, a document is rejected.

Part of the trusted documents of each language, by id hash, is not trained on: one
in ``folds``, or as many as make ``least`` of them, but at most half.  Trained texts
look too good, so they are held against the median of the trained ones of their
language and all others against that of the rest.  So measured, all trusted
documents of a language give both its quantiles, however many they are: means
of their own quantiles, with a weight of their number, and of those of all
languages, with a weight of ``least``.  Both ends move together, and nothing
switches at some size.

Defined results: a null or empty text has no perplexity and is rejected;
a document without a language, or in one without trusted documents, is held
against the median and quantiles of all texts together; without any trusted document nothing but texts
without content is rejected; repeated rows are scored each; a doc_id with
several labels is trusted if all of them are; rows with a null id cannot be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import ship, stage, text_bytes

ORDER = 4  # units of 16 bits: an n-gram is one 64-bit number, its last unit lowest
START, END = 2, 3  # control characters that stand before and after a text
MAX_UNITS = 1 << 20  # n-grams handled at a time
WINDOW = 256  # units in which repetition is looked for


def units_of(text: str) -> np.ndarray:
    """The text's UTF-16 units, ORDER - 1 marks before and one after."""
    body = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype=np.uint16)
    return np.concatenate([np.full(ORDER - 1, START, dtype=np.uint16), body, np.array([END], dtype=np.uint16)])


def ngrams(text: str) -> np.ndarray:
    """One number per unit of the text and for its end: the n-gram that ends there."""
    u = units_of(text).astype(np.uint64)
    n = len(u) - ORDER + 1
    key = u[:n].copy()
    for i in range(1, ORDER):
        key = (key << np.uint64(16)) | u[i: n + i]
    return key.view(np.int64)


def pieces(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(index, n-grams), of several texts together while they are short."""
    held, size = [], 0
    for i, t in enumerate(texts):
        g = ngrams(t)
        held.append((i, g))
        size += len(g)
        if size >= MAX_UNITS:
            yield held
            held, size = [], 0
    if held:
        yield held


def block_ngrams(docs: pd.DataFrame, trusted: set) -> pd.DataFrame:
    """Distinct n-grams of a block's texts, with their counts in the trusted ones."""
    parts = []
    training = docs["doc_id"].isin(trusted).to_numpy()
    for held in pieces(docs["text"].tolist()):
        codes, grams = pd.factorize(np.concatenate([g for _, g in held]))
        weight = np.repeat([training[i] for i, _ in held], [len(g) for _, g in held])
        parts.append(pd.DataFrame({"gram": grams, "n": np.bincount(codes, weights=weight, minlength=len(grams))}))
        if len(parts) > 8:
            parts = [pd.concat(parts).groupby("gram", sort=False, as_index=False)["n"].sum()]
    every = pd.concat(parts).groupby("gram", sort=False, as_index=False)["n"].sum()
    return every.astype({"n": "int64"})


def distinct_in_windows(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For texts of ``sizes`` n-grams each, whose numbers follow each other in
    ``codes``: the distinct ones in each window of a text, added up."""
    rows = -(-sizes // WINDOW)
    first = np.cumsum(rows) - rows
    shift = first * WINDOW - (np.cumsum(sizes) - sizes)
    windows = np.full((int(rows.sum()), WINDOW), -1, dtype=np.int32)
    windows.reshape(-1)[np.arange(len(codes)) + np.repeat(shift, sizes)] = codes
    windows.sort(axis=1)
    each = (windows[:, 0] >= 0).astype(np.int64)
    each += ((windows[:, 1:] != windows[:, :-1]) & (windows[:, 1:] >= 0)).sum(axis=1)
    return np.add.reduceat(each, first)


def block_scores(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Units, log loss and distinct n-grams in windows of each document, from its block's log probabilities."""
    known = known.sort_values("gram")
    grams, logp = known["gram"].to_numpy(), known["logp"].to_numpy()
    loss, count, fresh = np.zeros(len(docs)), np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
    for held in pieces(docs["text"].tolist()):
        codes, distinct = pd.factorize(np.concatenate([g for _, g in held]))
        each = logp[np.searchsorted(grams, distinct)][codes]
        sizes = np.array([len(g) for _, g in held])
        sums = np.add.reduceat(each, np.cumsum(sizes) - sizes)
        for (i, g), s, f in zip(held, sums, distinct_in_windows(codes, sizes), strict=True):
            loss[i], count[i], fresh[i] = -s, len(g), f
    return pd.DataFrame({"doc_id": docs["doc_id"], "lang": docs["lang"], "units": count, "loss": loss, "fresh": fresh})


def suffix(gram: Column, n: int) -> Column:
    """The last n units."""
    return gram.bitwiseAND(F.lit((1 << (16 * n)) - 1))


def prefix(gram: Column) -> Column:
    """All but the last unit."""
    return F.shiftrightunsigned(gram, 16)


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more, from four numbers of counts."""
    row = counts.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (row[f"n{i}"] for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    def of(i: int, a: int, b: int) -> float:
        return min(float(i), max(0.1, i - (i + 1) * y * b / a)) if a and b else 0.5 * i
    return of(1, n1, n2), of(2, n2, n3), of(3, n3, n4)


def probabilities(types: DataFrame) -> DataFrame:
    """(gram, logp) of every n-gram in ``types`` (gram, n: its count in the
    trusted texts, 0 if it is not in them)."""
    # count tables by order: full n-grams by occurrences, shorter ones by distinct predecessors
    tables = {ORDER: types}
    for k in range(ORDER - 1, 0, -1):
        longer = tables[k + 1]
        tables[k] = stage(longer.groupBy(suffix(F.col("gram"), k).alias("gram")).agg(
            F.sum((F.col("n") > 0).cast("long")).alias("n")), f"counts-{k}")
    alphabet = tables[1].where("n > 0").count() + 1
    lower = None
    for k in range(1, ORDER + 1):
        counts = tables[k]
        d1, d2, d3 = discounts(counts)
        n = F.col("n")
        context = counts.groupBy(prefix(F.col("gram")).alias("context")).agg(
            F.sum("n").alias("total"),
            (F.sum((n == 1).cast("long")) * d1 + F.sum((n == 2).cast("long")) * d2
             + F.sum((n >= 3).cast("long")) * d3).alias("left"))
        cut = F.when(n >= 3, n - d3).when(n == 2, n - d2).when(n == 1, n - d1).otherwise(0.0)
        own = counts.withColumn("context", prefix(F.col("gram"))).join(context, "context")
        if lower is None:
            below = F.lit(1.0 / alphabet)
        else:
            lower = lower.select(F.col("gram").alias("tail"), F.col("p").alias("below"))
            own = own.join(lower, suffix(own["gram"], k - 1) == lower["tail"])
            below = F.col("below")
        # an unseen context leaves everything to the shorter one
        p = F.when(F.col("total") > 0, (cut + F.col("left") * below) / F.col("total")).otherwise(below)
        lower = own.select("gram", p.alias("p"))
    return lower.select("gram", F.log("p").alias("logp"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids of which every label says good quality and nothing toxic."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(good.cast("int")).alias("good")).where(
        "good = 1").select("doc_id")


def dealt(docs: DataFrame, trusted: DataFrame, folds: int, least: int) -> DataFrame:
    """trusted_id and check (whether it is not trained on) of the trusted documents in ``docs``."""
    named = docs.select("doc_id", "lang").join(trusted, "doc_id").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    sizes = named.groupBy("lang").agg(F.count("*").alias("n")).withColumnRenamed("lang", "of")
    share = F.least(F.lit(0.5), F.greatest(F.lit(1.0 / folds), F.lit(float(least)) / F.col("n")))
    place = F.pmod(F.shiftright(F.xxhash64("doc_id"), 32), F.lit(1 << 20)) / F.lit(1 << 20)
    return stage(named.join(sizes, named["lang"].eqNullSafe(sizes["of"])).select(
        F.col("doc_id").alias("trusted_id"), (place < share).alias("check")), "folds")


def losses(docs: DataFrame, trusted: DataFrame, folds: int = 5, block_bytes: int = 24 << 20, least: int = 50) -> DataFrame:
    """doc_id, lang, units, loss (summed, natural logarithm) and fresh (distinct
    n-grams in each window, summed) of every row of ``docs``, and trusted: 'train', 'check' or null; written to the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    blocks = max(1, -(-text_bytes(docs) // block_bytes))
    key = F.xxhash64("doc_id")
    fold = dealt(docs, trusted, folds, least)
    own = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"), F.pmod(key, F.lit(blocks)).alias("block"))
    train = fold.where(~F.col("check")).select(
        F.col("trusted_id").alias("trusted"), F.pmod(F.xxhash64("trusted_id"), F.lit(blocks)).alias("block"))

    def distinct(mine: pd.DataFrame, ids: pd.DataFrame) -> pd.DataFrame:
        if mine.empty:
            return pd.DataFrame({"block": [], "gram": [], "n": []}).astype("int64")
        return block_ngrams(mine, set(ids["trusted"])).assign(block=mine["block"].iloc[0])[["block", "gram", "n"]]

    def scores(mine: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        return block_scores(mine, known)

    by_block = own.groupBy("block")
    grams = by_block.cogroup(train.groupBy("block")).applyInPandas(distinct, "block long, gram long, n long")
    grams = stage(grams, "ngrams")
    types = stage(grams.groupBy("gram").agg(F.sum("n").alias("n")), "counts")
    known = grams.select("block", "gram").join(probabilities(types), "gram")
    id_type, lang_type = (own.schema[c].dataType.simpleString() for c in ("doc_id", "lang"))
    scored = by_block.cogroup(known.groupBy("block")).applyInPandas(
        scores, f"doc_id {id_type}, lang {lang_type}, units long, loss double, fresh long")
    marked = fold.select("trusted_id", F.when(F.col("check"), "check").otherwise("train").alias("trusted"))
    return stage(scored.join(marked, scored["doc_id"] == marked["trusted_id"], "left").drop("trusted_id"), "losses")


def judge(docs: DataFrame, labels: DataFrame, folds: int = 5, shrink: int = 400, tails: tuple[float, float] = (0.005, 0.995),
          margin: float = 0.5, least: int = 50, block_bytes: int = 24 << 20) -> DataFrame:
    """doc_id, lang, units, perplexity, z and keep of every row of ``docs``
    (doc_id, text, lang); ``labels`` has doc_id, quality and toxic."""
    scored = losses(docs, trusted_ids(labels), folds, block_bytes, least)
    has_text = F.col("units") > 1
    scored = scored.withColumns({"mean": F.when(has_text, F.col("loss") / F.col("units")),
                                 "share": F.when(has_text, F.col("fresh") / F.col("units"))})
    trusted = "trusted IS NOT NULL AND mean IS NOT NULL"
    # each distance, of what, and the quantiles that bound it
    measures = {"z": ("mean", [*tails]), "fresh_z": ("share", [tails[0]])}

    def quantiles(value: str | Column, shares: list[float]) -> Column:
        return F.percentile_approx(value, shares, 10000)

    some = scored.where(trusted)
    middle = some.agg(*[quantiles(of, [0.5])[0].alias(of) for of, _ in measures.values()]).first()
    own = some.where("lang IS NOT NULL").groupBy(F.col("lang").alias("known"))

    def median(of: str, kind: str) -> Column:
        return quantiles(F.when(F.col("trusted") == kind, F.col(of)), [0.5])[0]

    medians = stage(own.agg(*[c for of, _ in measures.values() for c in (
        F.coalesce(median(of, "train"), median(of, "check")).alias(f"{of}_train"),
        F.coalesce(median(of, "check"), median(of, "train")).alias(f"{of}_rest"))]), "medians")
    shrunk = F.sqrt(F.col("units") / (F.col("units") + F.lit(shrink)))

    def everywhere(of: str) -> Column:  # without languages
        return (F.col(of) - F.lit(middle[of]).cast("double")) * shrunk

    def distance(of: str) -> Column:
        held_against = F.when(F.col("trusted") == "train", F.col(f"{of}_train")).otherwise(F.col(f"{of}_rest"))
        return F.coalesce((F.col(of) - held_against) * shrunk, everywhere(of))

    scored = scored.join(medians, scored["lang"] == medians["known"], "left")
    scored = stage(scored.withColumns({z: distance(of) for z, (of, _) in measures.items()}), "z")

    some = scored.where(trusted)
    ends = some.agg(*[c for z, (of, shares) in measures.items() for c in (
        quantiles(everywhere(of), shares).alias(f"{z}_every"),
        quantiles(F.when(F.col("known").isNotNull(), F.col(z)), shares).alias(f"{z}_centred"))]).first()
    own = some.where("known IS NOT NULL").groupBy(F.col("known").alias("of")).agg(
        F.count("*").alias("n"), *[quantiles(z, shares).alias(f"{z}_q") for z, (_, shares) in measures.items()])

    def bound(z: str, i: int) -> Column:
        centred = F.lit((ends[f"{z}_centred"] or [None, None])[i]).cast("double")
        return (F.col("n") * F.col(f"{z}_q")[i] + F.lit(least) * centred) / (F.col("n") + F.lit(least))

    bounds = stage(own.select("of", *[bound(z, i).alias(f"{z}_{i}") for z, (_, shares) in measures.items()
                                      for i in range(len(shares))]), "quantiles")
    joined = scored.join(bounds, scored["known"] == bounds["of"], "left")

    def end(z: str, i: int) -> Column:
        return F.coalesce(F.col(f"{z}_{i}"), F.lit((ends[f"{z}_every"] or [None, None])[i]).cast("double"))

    wide = F.lit(margin) * (end("z", 1) - end("z", 0))
    inside = F.coalesce(F.col("z").between(end("z", 0) - wide, end("z", 1) + wide), F.lit(True))
    varied = F.coalesce(F.col("fresh_z") >= end("fresh_z", 0) * F.lit(1 + margin), F.lit(True))
    return joined.select("doc_id", "lang", "units", F.exp("mean").alias("perplexity"), "z",
                         (F.col("mean").isNotNull() & inside & varied).alias("keep"))

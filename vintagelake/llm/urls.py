"""URL filters: path rules first, gradient-boosted trees on lexical features for the rest.

A rule is a verdict, a host and a path.  It fits its host and every subdomain
if the url's path starts with the rule's; of the rules that fit, the longest
decides.  Urls on which a rule decides are the labelled ones: the trees learn
from them what rules say, and judge the urls on which no rule does.

Features: length, path depth, digit ratio, character entropy, number of query
parameters, labels, digits and hyphens of the host, and statistics of suffixes:
the smoothed share of blocked urls among the labelled ones with the same last
one, two or three host labels, the same file ending, and the same first path
segment.  A labelled url's own fifth (by hash) is left out of its statistics,
so that the trees do not learn from a share that holds the answer.

Everything is DataFrame functions and Spark ML's trees; no Python runs on the
executors.  Bounds: the trees and statistics are fitted on about ``fit_rows``
different labelled urls, chosen by hash; a suffix needs ``least`` of them to
have a statistic of its own, so at most 5 * fit_rows / least rows are broadcast.

Defined results: host and path of a null url, or one without ``://``, are
empty, so no rule fits and the trees judge it; if the labelled urls all have
one verdict, that is the method's, and ``allow`` if there are none; repeated
rows and rows with a null id are judged like others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import stage

ALLOW, BLOCK = "allow", "block"
FOLDS = 5
SMOOTH = 10.0  # labelled urls that the overall share counts for
STATISTICS = ("suffix1", "suffix2", "suffix3", "ending", "head")
LEXICAL = ("length", "depth", "digits", "entropy", "params", "labels", "host_digits", "hyphens")


def parse(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a url; empty if it has no ``://``."""
    def part(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))

    host = F.translate(part(r"(?s)^.*?://([^/?#]*)"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, part(r"(?s)^.*?://[^/?#]*([^?#]*)"), part(r"(?s)^.*?://[^?#]*\?([^#]*)")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (as host + path), and its verdict; null without one.
    ``rules``: (verdict, host, path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(of + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def occurrences(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def lexical(url: Column, host: Column, path: Column, query: Column) -> dict[str, Column]:
    """The features that need nothing but the url, as doubles."""
    text = F.coalesce(url, F.lit(""))
    n = F.char_length(text)
    each = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.char_length(F.replace(text, c))).cast("double"))
    spread = F.aggregate(each, F.lit(0.0), lambda s, k: s + F.when(k > 0, k * F.log2(k)).otherwise(F.lit(0.0)))
    digits = "0123456789"
    out = {
        "length": n,
        "depth": occurrences(path, "/"),
        "digits": F.when(n > 0, occurrences(text, digits) / n).otherwise(F.lit(0.0)),
        "entropy": F.when(n > 0, F.log2(n.cast("double")) - spread / n).otherwise(F.lit(0.0)),
        "params": F.when(query == "", F.lit(0)).otherwise(occurrences(query, "&") + 1),
        "labels": F.when(host == "", F.lit(0)).otherwise(occurrences(host, ".") + 1),
        "host_digits": F.when(host != "", occurrences(host, digits) / F.char_length(host)).otherwise(F.lit(0.0)),
        "hyphens": occurrences(host, "-"),
    }
    return {k: v.cast("double") for k, v in out.items()}


def tokens(host: Column, path: Column) -> dict[str, Column]:
    """What the suffix statistics are kept for."""
    return {
        "suffix1": F.substring_index(host, ".", -1),
        "suffix2": F.substring_index(host, ".", -2),
        "suffix3": F.substring_index(host, ".", -3),
        "ending": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
        "head": F.regexp_extract(path, r"^/([^/]*)/", 1),
    }


def described(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str, url: str) -> DataFrame:
    """page_id, url, host, path, rule, said (the rule's verdict), lexical features and tokens of every row."""
    own = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"))
    host, path, query = parse(F.col("url"))
    own = own.select("page_id", "url", host.alias("host"), path.alias("path"), query.alias("query"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    return own.select("page_id", "url", "host", "path", rule.alias("rule"), said.alias("said"),
                      *[c.alias(k) for k, c in lexical(F.col("url"), F.col("host"), F.col("path"), F.col("query")).items()],
                      *[c.alias(f"of_{k}") for k, c in tokens(F.col("host"), F.col("path")).items()])


def labelled_sample(rows: DataFrame, fit_rows: int) -> DataFrame:
    """About ``fit_rows`` different labelled urls (all, if there are fewer), chosen by
    hash, with blocked (0 or 1) and their fold."""
    part = 1 << 30
    labelled = rows.where("said IS NOT NULL")
    total = labelled.agg(F.approx_count_distinct("url", 0.02).alias("n")).first()["n"]
    chosen = F.pmod(F.xxhash64("url"), F.lit(part)) < min(part, -(-fit_rows * part // max(total, 1)))
    return labelled.where(chosen).dropDuplicates(["url"]).select(
        (F.col("said") == BLOCK).cast("double").alias("blocked"), *LEXICAL, *[f"of_{k}" for k in STATISTICS],
        F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"))


def statistics(sample: DataFrame, least: int) -> DataFrame:
    """kind, token, n and b: labelled urls and blocked ones, by fold."""
    each = sample.select("fold", "blocked", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"of_{k}").alias("token")) for k in STATISTICS])).alias("of"))
    by_fold = [(F.col("fold") == i) for i in range(FOLDS)]
    return each.groupBy("of.kind", "of.token").agg(
        F.count("*").alias("total"),
        F.array(*[F.sum(f.cast("double")) for f in by_fold]).alias("n"),
        F.array(*[F.sum(F.when(f, F.col("blocked")).otherwise(F.lit(0.0))) for f in by_fold]).alias("b"),
    ).where(F.col("total") >= least).drop("total")


def with_statistics(rows: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    """``rows`` with a column for each statistic; rows with a fold do without that fold's labels."""
    def total(values: Column) -> Column:
        every = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
        return every - F.coalesce(F.get(values, F.col("fold")), F.lit(0.0))

    for kind in STATISTICS:
        of = F.broadcast(stats.where(F.col("kind") == kind).select(F.col("token").alias("__token"), "n", "b"))
        rows = rows.join(of, rows[f"of_{kind}"] == of["__token"], "left")
        share = (total(F.col("b")) + SMOOTH * prior) / (total(F.col("n")) + SMOOTH)
        rows = rows.withColumn(kind, F.coalesce(share, F.lit(prior))).drop("__token", "n", "b", f"of_{kind}")
    return rows


def fit(rows: DataFrame, fit_rows: int = 200_000, least: int = 20, trees: int = 20, depth: int = 3):
    """(model, statistics, share of blocked urls) from the rows of ``described``; the
    model is None if the labelled urls do not have both verdicts."""
    sample = stage(labelled_sample(rows, fit_rows), "labelled-urls")
    held = sample.agg(F.avg("blocked").alias("share")).first()["share"]
    stats = stage(statistics(sample, least), "suffix-statistics")
    if held is None or held in (0.0, 1.0):
        return None, stats, held or 0.0
    known = VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features").transform(
        with_statistics(sample, stats, held)).select("features", "blocked")
    known = stage(known, "url-features")
    model = GBTClassifier(labelCol="blocked", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7).fit(known)
    return model, stats, held


def score(rows: DataFrame, fitted) -> DataFrame:
    """``rows`` with a column score: how likely the method thinks a url is to be blocked."""
    model, stats, share = fitted
    rows = with_statistics(rows.withColumn("fold", F.lit(None).cast("int")), stats, share)
    if model is None:
        return rows.withColumn("score", F.lit(float(share)))
    model = model.setFeaturesCol("features")
    scored = model.transform(VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features").transform(rows))
    return scored.withColumn("score", vector_to_array("probability")[1])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url",
          threshold: float = 0.5, **fitting) -> DataFrame:
    """One row per row of ``pages``: page_id, url, host, path, rule, score and
    verdict (the rule's; else ``block`` from ``threshold`` on)."""
    rows = described(pages, rules, page_id, url)
    scored = score(rows, fit(rows, **fitting))
    method = F.when(F.col("score") >= threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select("page_id", "url", "host", "path", "rule", "score", F.coalesce("said", method).alias("verdict"))


def digest(judged: DataFrame) -> DataFrame:
    """The columns of the contract, and the method's score."""
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")

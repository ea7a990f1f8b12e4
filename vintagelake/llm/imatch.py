"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon keeps the terms whose document frequency lies in a band (that is,
whose inverse document frequency does): common words say little, and words of
a few documents break on any edit.  Each of ``SUBSETS`` random subsets of the
lexicon, of several densities, keeps some of a document's terms; the distinct
terms that are left (as 64-bit hashes) are sorted and hashed.  The fingerprint
is the list of these hashes; likeness is the share of equal hashes at the
density where the two documents agree best.

Everything is DataFrame functions.  The lexicon is broadcast; its size is
bounded whatever the corpus, since at most (mean distinct terms of a document)
/ ``low`` terms can be in that share of all documents.  A document's next one
is found inside blocks of consecutive ids; blocks hold about ``block_bytes`` of
text, and a block's last row takes the first text of the following block.

Defined results: a null text is empty; a text without terms has the marker of
an empty subset in every place, and is like another such text (1.0); every
text uses its lexicon terms and those of its other terms that a hash puts in
one of ``RATE`` parts, and if that leaves none, the one with the smallest hash; document
frequencies are counted over distinct texts; rows are ordered by doc_id,
nulls first, then by the text's hash; repeated rows are all returned; a single
row is its own next.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintagelake.llm.common import stage

SCALES = (2, 4, 6, 8, 10)  # a subset of scale s keeps one term in 2^s
PER_HASH, HASHES = 6, 3  # of 64 bits each repeat reads 10
REPEATS = PER_HASH * HASHES
SUBSETS = 1 + len(SCALES) * REPEATS  # and the whole lexicon
FEW = 4
RATE = 2  # of the terms outside the lexicon one in so many is used
EMPTY = "----"


def terms(text: Column) -> Column:
    """Distinct words of letters and digits, lower case."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def lexicon(docs: DataFrame, low: float, high: float, text: str = "text") -> DataFrame:
    """Terms that are in at least ``low`` and at most ``high`` of all distinct texts (at least two)."""
    docs = stage(docs.select(docs[text]).distinct(), "distinct-texts")
    n = docs.count()
    counts = docs.select(F.explode(terms(docs[text])).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return stage(counts.where(F.col("df").between(max(2.0, low * n), max(2.0, high * n))).select("term"), "lexicon")


def with_hashes(docs: DataFrame, kept: str, out: str) -> DataFrame:
    """``docs`` with the hash of each subset's terms in a column ``out``.  ``kept``:
    the sorted ids of a document's terms, 64-bit hashes of which every repeat reads
    10 bits of its own (after six repeats the hashes are hashed again): a term is in
    the repeat's subset of scale s if the lowest s of them are 0, so that a subset is
    filtered from the next larger one.

    A scale's subsets of all repeats are one column, made by a projection of its
    own: no lambda holds another scale's, so that what is evaluated for a row stays
    two loops deep at most."""
    def short(chosen: Column) -> Column:
        return F.when(F.size(chosen) == 0, F.lit(EMPTY)).otherwise(
            F.lower(F.lpad(F.hex(F.xxhash64(chosen).bitwiseAND(F.lit(0xFFFF))), 4, "0")))

    def filtered(ids: Column, scale: int, at: int) -> Column:
        mask = (1 << scale) - 1 << 10 * at
        return F.filter(ids, lambda t: t.bitwiseAND(F.lit(mask).cast("long")) == 0)

    def first(ids: Column) -> Column:
        return F.array(*[filtered(ids, SCALES[0], at) for at in range(PER_HASH)])

    def following(scale: int) -> Callable[[Column], Column]:
        return lambda own: F.array(*[filtered(F.get(own, F.lit(at)), scale, at) for at in range(PER_HASH)])

    def rehashed(k: int) -> Column:
        return F.sort_array(F.transform(kept, lambda t: F.xxhash64(t, F.lit(k))))

    docs = docs.withColumn("__hashed", F.array(F.col(kept), *[rehashed(k) for k in range(1, HASHES)]))
    docs = docs.withColumn(f"__scale{SCALES[0]}", F.transform("__hashed", first))
    for larger, scale in zip(SCALES, SCALES[1:], strict=False):
        docs = docs.withColumn(f"__scale{scale}", F.transform(f"__scale{larger}", following(scale)))
    prints = F.arrays_zip(*[F.transform(F.flatten(f"__scale{s}"), short) for s in SCALES])
    each = F.transform(prints, lambda z: F.array(*[z[str(i)] for i in range(len(SCALES))]))
    return docs.withColumn(out, F.concat(F.array(short(F.col(kept))), F.flatten(each))).drop(
        "__hashed", *[f"__scale{s}" for s in SCALES])


def likeness(a: Column, b: Column) -> Column:
    """Largest share of equal hashes at one density, among subsets that keep a
    term of either document (at least ``FEW`` of them); 1 for equal lists."""
    # for each density how many hashes to compare, and how many are equal: one number, 5 bits for each (18 at most)
    same = F.zip_with(a, b, lambda x, y: F.when((x != EMPTY) | (y != EMPTY), F.when(x == y, 33).otherwise(1)).otherwise(0))
    placed = F.transform(F.slice(same, 2, SUBSETS - 1), lambda x, at: F.call_function(
        "shiftleft", x.cast("long"), F.pmod(at, F.lit(len(SCALES))) * 10))
    counts = F.aggregate(placed, F.lit(0).cast("long"), lambda n, x: n + x)

    def best(of: Column) -> Column:
        def five(at: int) -> Column:
            return F.shiftrightunsigned(of, at).bitwiseAND(F.lit(31))

        return F.greatest(F.lit(0.0), *[F.when(five(10 * i) >= FEW, five(10 * i + 5) / five(10 * i)).otherwise(F.lit(0.0))
                                        for i in range(len(SCALES))])

    # counted once, then used by name
    return F.when(a == b, F.lit(1.0)).otherwise(F.get(F.transform(F.array(counts), best), F.lit(0)))


def in_blocks(docs: DataFrame, block_bytes: int, cells: int = 1 << 16) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) with a column block: blocks are runs of
    consecutive ids, numbered from 0.  The ids' range is cut in equal cells,
    whose sizes (at most ``cells`` numbers) tell which neighbours to put together."""
    span = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = float(span["low"] or 0), float(span["high"] or 0)
    width = max(1.0, (high - low) / (cells - 2))
    cell = F.coalesce(F.floor((F.col("doc_id").cast("double") - F.lit(low)) / F.lit(width)) + 1, F.lit(0)).cast("long")
    own = docs.withColumn("cell", cell)
    held = own.groupBy("cell").agg(F.sum(F.octet_length("text") + 16).alias("size")).toArrow().sort_by("cell")
    sizes = held["size"].to_numpy()
    at = (np.cumsum(sizes) - sizes) // block_bytes
    block = np.cumsum(np.r_[0, np.diff(at) > 0]) if len(at) else at
    of = docs.sparkSession.createDataFrame(
        pa.table({"cell": held["cell"].to_numpy().astype(np.int64), "block": block.astype(np.int64)}),
        schema="cell long, block long")
    # at most ``cells`` rows of two numbers: 1 MB
    return own.join(F.broadcast(of), "cell").drop("cell"), int(block[-1]) + 1 if len(block) else 0


def fingerprints(docs: DataFrame, low: float = 0.002, high: float = 0.1, block_bytes: int = 2 << 20,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256 (of the
    edited text: its first three quarters, then the beginning of the next text), fingerprint and
    edited_fingerprint (arrays), near_edited and near_next."""
    own = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    words = lexicon(own, low, high)
    blocked, n_blocks = in_blocks(own, block_bytes)
    blocked = blocked.repartition(max(n_blocks, 1), "block")

    # the first text of each block: one small row per block, found by the ids first
    heads = stage(blocked.groupBy("block").agg(F.min("doc_id").alias("first_id")), "block-heads")
    first = blocked.join(heads.withColumnRenamed("block", "of"), F.col("doc_id").eqNullSafe(F.col("first_id")) & (
        F.col("block") == F.col("of"))).groupBy("of").agg(F.min_by("text", F.xxhash64("text")).alias("first_text"))
    null_first = blocked.where("doc_id IS NULL").groupBy("block").agg(
        F.min_by("text", F.xxhash64("text")).alias("null_text"))
    first = stage(first.join(null_first, first["of"] == null_first["block"], "full").select(
        F.pmod(F.coalesce("of", "block") - 1, F.lit(max(n_blocks, 1))).alias("ends"),
        F.coalesce("null_text", "first_text").alias("first_text")), "block-texts")

    by_id = Window.partitionBy("block").orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows = blocked.withColumns({"place": F.row_number().over(by_id), "next": F.lead("text").over(by_id)})
    rows = rows.join(first, (rows["block"] == first["ends"]) & rows["next"].isNull(), "left").select(
        "block", "place", "doc_id", "text", F.coalesce("next", "first_text").alias("next"),
        F.col("first_text").isNotNull().alias("is_last"))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next"), F.lit(1), quarter))
    rows = rows.select("block", "place", "doc_id", "text", "next", "is_last", n.cast("long").alias("n_chars"),
                       edited.alias("edited"))

    # version 0: the text; 1: edited; 2, at the end of a block: the next text
    versions = F.concat(F.array(terms(F.col("text")), terms(F.col("edited"))),
                        F.when(F.col("is_last"), F.array(terms(F.col("next")))).otherwise(F.array()))
    each = rows.select("block", "place", "doc_id", "n_chars",
                       F.unhex(F.sha2(F.encode("edited", "UTF-8"), 256)).alias("edited_sha256"),
                       F.posexplode(versions).alias("version", "terms"))
    each = each.select("block", "place", "doc_id", "n_chars", "edited_sha256", "version",
                       F.explode_outer("terms").alias("term"))
    known = words.select(F.col("term").alias("known"))
    each = each.join(F.broadcast(known), each["term"] == known["known"], "left")
    # one rule for every text; the term with the smallest hash stands for a text of which none is used
    place = F.xxhash64("term", F.lit(1))
    used = F.col("known").isNotNull() | (F.pmod(place, F.lit(RATE)) == 0)
    chosen = each.groupBy("block", "place", "version").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
        F.first("edited_sha256").alias("edited_sha256"),
        F.collect_list(F.when(F.col("term").isNotNull() & used, F.xxhash64("term"))).alias("used"),
        F.min(F.when(F.col("term").isNotNull(), F.struct(place, F.xxhash64("term").alias("id"))))["id"].alias("spare"))
    kept = F.when(F.size("used") > 0, F.sort_array("used")).when(
        F.col("spare").isNotNull(), F.array("spare")).otherwise(F.array().cast("array<long>"))
    printed = with_hashes(chosen.select("block", "place", "version", "doc_id", "n_chars", "edited_sha256",
                                        kept.alias("kept")), "kept", "print")

    def of(v: int) -> Column:
        return F.max(F.when(F.col("version") == v, F.col("print")))

    prints = printed.groupBy("block", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
        F.lower(F.hex(F.first("edited_sha256"))).alias("edited_sha256"),
        of(0).alias("fingerprint"), of(1).alias("edited_fingerprint"), of(2).alias("after"))
    by_place = Window.partitionBy("block").orderBy("place")
    prints = prints.withColumn("after", F.coalesce("after", F.lead("fingerprint").over(by_place)))
    return prints.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                         likeness(F.col("fingerprint"), F.col("after")).alias("near_next"))


def digest(prints: DataFrame) -> DataFrame:
    """The columns of the contract, from the operator's output."""
    return prints.withColumns({c: F.array_join(c, "") for c in ("fingerprint", "edited_fingerprint")})

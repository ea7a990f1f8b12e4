"""Sharding by minimax contiguous partition.

Rows with equal texts are an atomic group.  A group's place in the order is the
bucket of its text's hash (``buckets`` of them, so what the driver sees is
bounded whatever the corpus); all groups of a bucket stay together.  The
smallest feasible capacity of a shard is found by binary search over the
ordered bucket sizes, each candidate checked greedily, and the order is cut
there.  No shard is larger than that capacity, and none could do with less as
long as buckets are not split.

Defined results: a null text has no bytes and CRC 0, as an empty one, and is
in its group; with fewer non-empty buckets than shards the
last shards stay empty; repeated rows get a slot each; an empty table gives no
rows.  Every row counts its UTF-8 bytes plus ``overhead``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintagelake.llm.common import stage


def greedy_cuts(ends: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """First bucket after each shard when every shard is filled up to the
    capacity; None if the buckets do not all fit.  ``ends``: running totals."""
    if not len(ends):
        return [0] * shards
    cuts, at, before = [], 0, 0
    for _ in range(shards):
        at = int(np.searchsorted(ends, before + capacity, side="right"))
        cuts.append(at)
        if at == len(ends):
            return cuts + [at] * (shards - len(cuts))
        before = int(ends[at - 1]) if at else 0
    return None


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity that lets ``shards`` runs of consecutive sizes hold all, and its cuts."""
    ends = np.cumsum(sizes, dtype=np.int64)
    if not len(ends):
        return 0, [0] * shards
    low, high = max(int(sizes.max()), -(-int(ends[-1]) // shards)), int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low, even_cuts(ends, low, shards)


def even_cuts(ends: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Cuts under the same capacity that leave no remainder shard: each shard
    takes about its share of what is left, or as much as the others need it to."""
    cuts, at, before = [], 0, 0
    for left in range(shards, 0, -1):
        furthest = int(np.searchsorted(ends, before + capacity, side="right"))
        share = before + (int(ends[-1]) - before) / left
        near = int(np.searchsorted(ends, share))  # the bucket in which the share ends
        for cut in sorted((near, near + 1), key=lambda c: abs((int(ends[min(c, len(ends)) - 1]) if c else 0) - share)):
            held = int(ends[cut - 1]) if 0 < cut <= len(ends) else 0
            if at <= cut <= furthest and greedy_cuts(ends[cut:] - held, capacity, left - 1) is not None:
                break
        else:
            cut = furthest
        at, before = cut, int(ends[cut - 1]) if cut else 0
        cuts.append(at)
    return cuts


def assign(docs: DataFrame, shards: int = 40, overhead: int = 16, buckets: int = 1 << 18, block: int = 2000,
           text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard and slot
    (numbers each shard's rows from 0, without gaps).

    ``block``: rows numbered by one window group at most, about; a bucket with
    more rows is numbered in several groups, each behind the ones before.
    """
    spark = docs.sparkSession
    body = F.coalesce(docs[text], F.lit(""))
    rows = stage(docs.select(
        docs[doc_id].alias("doc_id"),
        (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(body), F.lit(buckets)).alias("bucket")), "sizes")

    held = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("size")).toArrow().sort_by("bucket")
    number, count = (held[c].to_numpy() for c in ("bucket", "n"))
    _, cuts = minimax_cuts(held["size"].to_numpy(), shards)
    shard = np.searchsorted(np.array(cuts), np.arange(len(number)), side="right")
    before = np.cumsum(count) - count
    first = np.r_[0, cuts[:-1]].astype(np.int64)
    first_slot = before - (before[first[shard]] if len(number) else 0)
    places = spark.createDataFrame(pa.table({
        "bucket": number, "shard": shard.astype(np.int32), "first_slot": first_slot.astype(np.int64),
        "parts": (count // block + 1).astype(np.int64)}), schema="bucket long, shard int, first_slot long, parts long")

    # at most ``buckets`` rows of four numbers: 8 MB
    placed = rows.join(F.broadcast(places), "bucket").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.col("parts")))
    split = placed.where("parts > 1").groupBy("bucket", "part").agg(F.count("*").alias("n"))
    ahead = split.select("bucket", "part", (F.sum("n").over(
        Window.partitionBy("bucket").orderBy("part")) - F.col("n")).alias("ahead"))
    numbered = placed.withColumn("i", F.row_number().over(
        Window.partitionBy("bucket", "part").orderBy("doc_id", "text_crc32", "size")))
    return numbered.join(ahead, ["bucket", "part"], "left").select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("first_slot") + F.coalesce("ahead", F.lit(0)) + F.col("i") - 1).cast("long").alias("slot"))


def digest(assigned: DataFrame) -> DataFrame:
    """The columns of the contract: the law kept here is that of near equal bytes."""
    return assigned.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"))

"""SimHash near-duplicates found through a Gray-order hierarchical index.

Fingerprint: lower-case A-Z, words between ASCII white space, shingles of
``shingle`` words (repeats included) joined by a space, XXH64 (seed 42) of each;
a bit is set if it is set in more than half of the hashes.

Links (at most ``bits`` differing bits) are searched among distinct
fingerprints.  The 64 bits are cut in ``bits + 1`` segments; two fingerprints
within the distance agree in a whole segment, so a segment and its value name a
bucket and every link lies in a bucket.  A bucket with more than ``most``
fingerprints is cut again in the same way by its remaining bits, which keeps
every link and ends by itself, since distinct fingerprints that agree in ever
more bits become few.  In each bucket the fingerprints are sorted by Gray rank and a tree
is built over them: a node keeps the bit pattern that all below it share, under
a mask, without the bits that its own parent already has.  A query goes down
the tree with the differences counted so far and drops a whole node when they
exceed the distance.  Of a bucket's links a spanning forest is kept, so a ball
of near copies gives as many links as it has members, not their square.

Defined results: a null, empty or blank text has fingerprint zero and links
like any other; rows with equal fingerprints are one class; a class's id is its
smallest doc_id (nulls are left out of the minimum; a class of null ids only
has a null id); repeated rows are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import ship, stage
from vintagelake.llm.components import connected_components

SEED = 42
FAN = 16  # children of an index node
ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(p, SEED) for p in parts]), dtype=np.uint8)
    n = len(hashes) // 8
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):  # a block of hashes at a time: bounded memory for long texts
        block = hashes[8 * at: 8 * (at + (1 << 16))].reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits of the fingerprint as a signed long."""

    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(docs[doc_id].alias("doc_id"), fp(F.coalesce(docs[text], F.lit(""))).alias("fp"))


# ---- the index over one batch of buckets ---------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the order of the binary reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A forest over codes, one tree per bucket; codes are in (bucket, Gray rank) order."""

    def __init__(self, bucket: np.ndarray, codes: np.ndarray):
        # level 0 is the codes; above it, groups of up to FAN neighbours, until one root per bucket
        self.levels = []
        ones, zeros, of = codes, codes, bucket
        first, count = np.arange(len(codes)), np.ones(len(codes), dtype=np.int64)
        self._add(ones, zeros, first, count)
        while len(of) > len(np.unique(of)):
            starts = np.r_[True, of[1:] != of[:-1]]
            place = np.arange(len(of)) - np.maximum.accumulate(np.where(starts, np.arange(len(of)), 0))
            heads = np.flatnonzero(starts | (place % FAN == 0))
            ones = np.bitwise_and.reduceat(ones, heads)  # bits set in all below
            zeros = np.bitwise_or.reduceat(zeros, heads)  # bits clear in all below are clear here
            self._add(ones, zeros, heads, np.diff(np.r_[heads, len(of)]))
            of = of[heads]
        _, self.root = np.unique(bucket, return_inverse=True)
        above = np.zeros(len(of), dtype=np.uint64)
        for level in reversed(self.levels):  # a node leaves out the bits its parent has
            mask = level["mask"]
            level["own"] = mask & ~above
            above = np.repeat(mask, level["count"]) if level is not self.levels[0] else above

    def _add(self, ones, zeros, first, count):
        self.levels.append({"pattern": ones, "mask": ~(ones ^ zeros), "first": first, "count": count})

    def links(self, codes: np.ndarray, bits: int, block: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions (query, found) with query < found, within ``bits``."""
        for lo in range(0, len(codes), block):
            query = np.arange(lo, min(lo + block, len(codes)))
            stack = [(len(self.levels) - 1, query, self.root[query], np.zeros(len(query), dtype=np.uint8))]
            while stack:
                depth, query, node, differ = stack.pop()
                if len(query) > 1 << 20:  # bounded memory: halves, one after the other
                    half = len(query) // 2
                    stack += [(depth, query[half:], node[half:], differ[half:]),
                              (depth, query[:half], node[:half], differ[:half])]
                    continue
                level = self.levels[depth]
                differ = differ + np.bitwise_count((codes[query] ^ level["pattern"][node]) & level["own"][node])
                near = differ <= bits
                query, node, differ = query[near], node[near], differ[near]
                if depth == 0:
                    later = node > query
                    if later.any():
                        yield query[later], node[later]
                    continue
                count = level["count"][node]
                child = np.repeat(level["first"][node], count)
                child += np.arange(len(child)) - np.repeat(np.cumsum(count) - count, count)
                stack.append((depth - 1, np.repeat(query, count), child, np.repeat(differ, count)))


def union(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the classes of x[i] and y[i]; a label is the position of a class's least member."""
    while len(x):
        a, b = label[x], label[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _search(bits: int):
    def links_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Spanning links of each bucket; rows come sorted by bucket, and one
        bucket may go on in the next frame."""
        rest = None

        def found(part: pd.DataFrame) -> pd.DataFrame:
            k1, k2 = part["k1"].to_numpy(), part["k2"].to_numpy()
            bucket = np.cumsum(np.r_[False, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            codes = part["fp"].to_numpy().view(np.uint64)
            order = np.lexsort((gray_rank(codes), bucket))
            bucket, codes = bucket[order], codes[order]
            label = np.arange(len(codes))
            for x, y in GrayIndex(bucket, codes).links(codes, bits):
                union(label, x, y)
            linked = np.flatnonzero(label != np.arange(len(label)))
            return pd.DataFrame({"a": codes[label[linked]].view(np.int64), "b": codes[linked].view(np.int64)})

        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            last = frame[["k1", "k2"]].iloc[-1]
            whole = ((frame["k1"] != last["k1"]) | (frame["k2"] != last["k2"])).to_numpy()
            if whole.any():
                yield found(frame[whole])
            rest = frame[~whole]
        if rest is not None and len(rest):
            yield found(rest)

    return links_of


def _segments(masks: list[int], parts: int) -> list[tuple[int, list[int]]]:
    """Bit positions cut in ``parts`` runs of nearly equal length."""
    n = len(masks)
    return [(i, masks[n * i // parts: n * (i + 1) // parts]) for i in range(parts)]


def _mask(positions: list[int]) -> int:
    m = sum(1 << p for p in positions)
    return m - (1 << 64) if m >= 1 << 63 else m


def near_links(codes: DataFrame, bits: int = 2, most: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``codes.fp`` that connect
    exactly what pairs within ``bits`` differing bits connect.

    ``most``: fingerprints of a bucket above which it is cut again; it bounds
    the memory of a task, not the result.
    """
    ship(codes.sparkSession)
    links = None
    # a level's rows: fp, path (which segments have been fixed so far), with the bits still free by path
    level, free = codes.select("fp", F.lit(0).alias("path")), {0: list(range(64))}
    while True:
        buckets, below = None, {}
        cuts = []
        for path, positions in free.items():
            for i, run in _segments(positions, bits + 1):
                below[path * (bits + 1) + i + 1] = [p for p in positions if p not in run]
                cuts.append((path, path * (bits + 1) + i + 1))
        # k1: the segments fixed so far; k2: the bits in them
        parts = [F.struct(F.lit(new).alias("k1"),
                          F.col("fp").bitwiseAND(F.lit(~_mask(below[new])).cast("long")).alias("k2")) for _, new in cuts]
        of = {p: F.array(*[x for (q, _), x in zip(cuts, parts, strict=True) if q == p]) for p in free}
        which = F.lit(None)
        for p, a in of.items():
            which = F.when(F.col("path") == p, a).otherwise(which) if p else a
        buckets = level.select("fp", F.explode(which).alias("k")).select(
            "fp", F.col("k.k1").cast("long").alias("k1"), "k.k2")
        sizes = buckets.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1")
        sizes = stage(sizes, "buckets")
        keyed = buckets.join(sizes, ["k1", "k2"])
        deepest = all(len(p) <= 12 for p in below.values())  # at most 2^12 distinct fingerprints then
        small = keyed if deepest else keyed.where(F.col("n") <= most)
        found = (small.select("k1", "k2", "fp").repartition("k1", "k2").sortWithinPartitions("k1", "k2")
                 .mapInPandas(_search(bits), "a long, b long"))
        found = stage(found, "near")
        links = found if links is None else links.union(found)
        if deepest or sizes.where(F.col("n") > most).isEmpty():
            return links
        paths = [r["k1"] for r in sizes.where(F.col("n") > most).select("k1").distinct().collect()]
        free = {p: below[p] for p in paths}  # as many as there are segment choices: few
        level = stage(keyed.where(F.col("n") > most).select("fp", F.col("k1").alias("path")), "crowded")


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id."""
    fps = stage(fingerprints(docs, shingle, text, doc_id), "fingerprints")
    codes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = near_links(codes.select("fp"), bits)
    roots = connected_components(links)
    class_of = codes.join(roots, codes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = class_of.groupBy("root").agg(F.min("least").alias("component_id"))
    by_code = class_of.join(ids, "root").select(F.col("fp").alias("code"), "component_id")
    return fps.join(by_code, fps["fp"] == by_code["code"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

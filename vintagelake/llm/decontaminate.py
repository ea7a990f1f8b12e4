"""Benchmark decontamination with a document-sharded positional inverted index.

``build_index`` writes postings: documents are taken in shards (the batches a
task reads), every word of a shard has a position in it, and for every test
term that occurs the shard stores the ascending list of its positions.  Only
terms of the test items are stored, since no other list is ever asked for.

``search`` goes, shard by shard, through the terms that the shard holds, and
from each to the windows of which it is the rarest term (the one in fewest of
all windows): a window whose rarest term a shard lacks costs nothing there.  It
intersects the position lists of the window's terms, each moved back by the
term's offset in the window, beginning with the term whose list is shortest in
the shard; what is left are the exact phrase's beginnings.
A proximity match needs every term of the window within ``slop`` words of an
occurrence of the rarest one, in any order; it is reported, and does not count
as a hit.

Test items are the stated query set.  They are sent to the tasks in blocks of
at most ``block_bytes`` of text, one pass over the documents for each, so what
a task holds of them is bounded however many there are: the numbers of a
block's words and, for each different window, where it stands among them (about
30 bytes a window).

Words: A-Z is lower-cased and everything in ASCII but letters and digits
separates.  Defined results: a null or wordless text has no words and is never
hit; items without words are no items; an item
without an id is listed as ''; items of fewer than ``width`` words are
one window; equal windows of several items count for each item; repeated rows
are each returned; an empty item table hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vintagelake.llm.common import ship, stage

#: ASCII letters in lower case, digits and all bytes of other characters stay; the rest separates.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(WORDS).split()


class Windows:
    """The different windows of a block of items, as places in one array of word numbers."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        self.names = [i for i, _ in items]
        found = [words(text) for _, text in items]
        self.terms = sorted({t for w in found for t in w})
        number = {t: i for i, t in enumerate(self.terms)}
        sizes = np.array([len(w) for w in found], dtype=np.int64)
        self.words = np.fromiter((number[t] for w in found for t in w), dtype=np.int32, count=int(sizes.sum()))
        begins = np.cumsum(sizes) - sizes
        held: dict[bytes, int] = {}
        starts, lengths, of = [], [], []  # of: (window, item)
        for i, (begin, n) in enumerate(zip(begins.tolist(), sizes.tolist(), strict=True)):
            length = min(n, width)
            for at in range(begin, begin + max(1, n - width + 1) if n else begin):
                window = held.setdefault(self.words[at:at + length].tobytes(), len(starts))
                if window == len(starts):
                    starts.append(at)
                    lengths.append(length)
                of.append((window, i))
        self.starts, self.lengths = np.array(starts, dtype=np.int32), np.array(lengths, dtype=np.int16)
        # the items of each window, and the windows of which a term is the rarest, as runs
        pairs = np.unique(np.array(of, dtype=np.int32).reshape(-1, 2), axis=0)
        self.items, self.item_runs = pairs[:, 1].copy(), np.searchsorted(pairs[:, 0], np.arange(len(starts) + 1)).astype(np.int32)
        often, rarest = np.zeros(len(self.terms), dtype=np.int64), np.zeros(len(starts), dtype=np.int32)
        for n in np.unique(self.lengths).tolist():
            same = np.flatnonzero(self.lengths == n)
            for at in (same[k:k + 100_000] for k in range(0, len(same), 100_000)):
                rows = np.sort(self.words[self.starts[at][:, None] + np.arange(n)], axis=1)
                first = np.c_[np.ones(len(rows), dtype=bool), rows[:, 1:] != rows[:, :-1]]
                often += np.bincount(rows[first], minlength=len(often))
        for n in np.unique(self.lengths).tolist():
            same = np.flatnonzero(self.lengths == n)
            for at in (same[k:k + 100_000] for k in range(0, len(same), 100_000)):
                rows = self.words[self.starts[at][:, None] + np.arange(n)]
                rarest[at] = rows[np.arange(len(at)), often[rows].argmin(axis=1)]
        self.by_rarest = np.argsort(rarest, kind="stable").astype(np.int32)
        self.rarest_runs = np.searchsorted(rarest[self.by_rarest], np.arange(len(self.terms) + 1)).astype(np.int32)

    def of_rarest(self, term: int) -> list[int]:
        return self.by_rarest[self.rarest_runs[term]:self.rarest_runs[term + 1]].tolist()

    def of_window(self, window: int) -> list[str]:
        return [self.names[i] for i in self.items[self.item_runs[window]:self.item_runs[window + 1]].tolist()]

    def window(self, window: int) -> list[int]:
        at = self.starts[window]
        return self.words[at:at + self.lengths[window]].tolist()


INDEX = "shard long, term int, positions binary, doc binary"


def build_index(docs: DataFrame, names: list[bytes], gap: int, text: str, row: list[str]) -> DataFrame:
    """Rows (shard, term's place in ``names``, positions) and, with a null term, (shard, null,
    beginnings of the documents, the documents' own columns); written to the
    shared folder.  ``gap`` free positions between documents keep a window or a
    proximity match from reaching into the next one."""
    ship(docs.sparkSession)
    numbers = {t: i for i, t in enumerate(names)}

    def postings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        part = TaskContext.get().partitionId()
        for batch, frame in enumerate(frames):
            found, places, counts, at = [], [], [], 0
            starts = np.empty(len(frame), dtype=np.int64)
            for i, t in enumerate(frame["__text"]):
                w = words(t)
                starts[i] = at
                counts.append(len(w))
                ids = np.fromiter(map(numbers.get, w, [-1] * len(w)), dtype=np.int32, count=len(w))
                here = np.flatnonzero(ids >= 0)
                found.append(ids[here])
                places.append(here + at)
                at += len(w) + gap
            found, places = np.concatenate(found), np.concatenate(places)
            order = np.argsort(found, kind="stable")
            found, places = found[order], places[order]
            heads = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.array([], dtype=int)
            shard = part << 24 | batch
            own = pa.RecordBatch.from_pandas(frame.drop(columns="__text").assign(__n=counts), preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own.schema) as out:
                out.write_batch(own)
            tails = np.r_[heads[1:], len(found)] if len(heads) else heads
            yield pd.DataFrame({
                "shard": shard,
                "term": pd.array([*found[heads].tolist(), None], dtype="Int32"),
                "positions": [places[a:b].astype(np.int32).tobytes() for a, b in zip(heads, tails, strict=True)]
                + [starts.tobytes()],
                "doc": [None] * len(heads) + [sink.getvalue().to_pybytes()],
            })

    return stage(docs.select(*row, docs[text].alias("__text")).mapInPandas(postings, INDEX), "postings")


def _match(lists: list[np.ndarray]) -> np.ndarray:
    """Beginnings of an exact phrase: lists by offset in the phrase."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    start = lists[order[0]] - order[0]
    for i in order[1:]:
        if not len(start):
            break
        other, want = lists[i], start + i
        start = start[other[np.minimum(np.searchsorted(other, want), len(other) - 1)] == want]
    return start


def _near(lists: list[np.ndarray], slop: int) -> np.ndarray:
    """Places of the rarest term that have every other term within ``slop`` words."""
    lists = sorted(lists, key=len)
    place = lists[0]
    for other in lists[1:]:
        if not len(place):
            break
        at = np.searchsorted(other, place - slop)
        place = place[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= place + slop)]
    return place


HITS = "n_words long, n_hit long, starts binary, items array<string>, near array<string>"


def search(index: DataFrame, asked: Windows, slop: int, schema: str) -> DataFrame:
    """Matches of each document: its own columns, n_words, the hit positions
    (binary, 64-bit) and the ids of the items found exactly and by proximity."""
    def matches(shard: pd.DataFrame) -> pd.DataFrame:
        import pyarrow as pa

        head = shard[shard["term"].isna()].iloc[0]
        own = pa.ipc.open_stream(head["doc"]).read_all().to_pandas()
        starts, counts = np.frombuffer(head["positions"], dtype=np.int64), own.pop("__n").to_numpy()
        rest = shard[shard["term"].notna()]
        lists = {int(t): np.frombuffer(p, dtype=np.int32) for t, p in zip(rest["term"], rest["positions"], strict=True)}
        hit = np.zeros(int(starts[-1] + counts[-1]) if len(starts) else 0, dtype=bool)
        exact: list[set[str]] = [set() for _ in starts]
        near: list[set[str]] = [set() for _ in starts]
        for window in (w for term in lists for w in asked.of_rarest(term)):
            of_terms = [lists.get(t) for t in asked.window(window)]
            if any(x is None for x in of_terms):
                continue
            begin = _match(of_terms)
            for i in range(len(of_terms) if len(begin) else 0):
                hit[begin + i] = True
            for into, places in ((exact, begin), (near, _near(of_terms, slop))):
                for d in np.unique(np.searchsorted(starts, places, side="right") - 1).tolist():
                    into[d].update(asked.of_window(window))
        own["n_words"] = counts
        inside = [np.flatnonzero(hit[s: s + n]) for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
        own["n_hit"] = [len(x) for x in inside]
        own["starts"] = [x.astype(np.int64).tobytes() for x in inside]
        own["items"] = [sorted(x) for x in exact]
        own["near"] = [sorted(x) for x in near]
        return own

    return index.groupBy("shard").applyInPandas(matches, schema)


def item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The test items in order, at most ``block_bytes`` of text (or one item) at a time."""
    block, held = [], 0
    for row in items.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        size = len((row[1] or "").encode("utf-8"))
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row[0] or "", row[1]))
        held += size
    if block:
        yield block


def contamination(docs: DataFrame, items: DataFrame, width: int = 13, slop: int = 26, text: str = "text",
                  doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an exact
    occurrence of a window), items (ids found exactly) and near (ids found by
    proximity, a superset), both sorted as strings."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, text_key long, {HITS}"
    kept = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_key"), docs[text].alias("text"))
    row = ["doc_id", "text_key"]
    found = []
    for block in item_blocks(items, item_id, item_text, block_bytes):
        asked = Windows(block, width)
        index = build_index(kept, asked.terms, gap=max(width, slop) + 1, text="text", row=row)
        found.append(search(index, asked, slop, schema))
    if not found:
        asked = Windows([], width)
        found.append(search(build_index(kept, [], gap=1, text="text", row=row), asked, slop, schema))
    if len(found) == 1:
        return found[0].drop("starts", "text_key")
    return _over_blocks([stage(f, "matches") for f in found])


def _over_blocks(found: list[DataFrame]) -> DataFrame:
    """Matches of the same documents by several blocks of items, put together.
    Equal rows of the documents are told apart by their number among equals."""
    tagged = []
    for f in found:
        same = Window.partitionBy("doc_id", "text_key").orderBy("n_words")
        tagged.append(f.withColumn("copy", F.row_number().over(same)))
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t)
    grouped = every.groupBy("doc_id", "text_key", "n_words", "copy").agg(
        F.collect_list("starts").alias("starts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"))

    @F.pandas_udf("long")
    def distinct_places(parts: pd.Series) -> pd.Series:
        return parts.map(lambda x: len(np.unique(np.frombuffer(b"".join(x), dtype=np.int64))))

    return grouped.select("doc_id", "n_words", distinct_places("starts").alias("n_hit"), "items", "near")


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of the contract, from the operator's output."""
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))

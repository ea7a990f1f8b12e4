"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A text is encoded once by each tokenizer.  Byte offsets where tokens of both end
cut them into groups; tokens of one group are linked.  A pair of token ids counts
the documents, of the whole table, that hold it linked.

All work on tokens is on Arrow columns, in blocks of ``block_bytes`` of text.
Both tokenizers start a token at a space between two characters that are no
white space, so a text is cut there into words, and each different word of a
block is encoded and aligned once: lists are flattened beside their parent
indices, segmented cumulative sums of token lengths give every token's end, an
Acero hash join on word-end keys (document-end keys, where a text is one word)
finds the shared ends, a second one on group numbers the links, and
``Table.group_by`` folds them to different pairs.  A text with a space at an end
or beside other white space is one word, and so is every text if some entry of
B holds a space after another character.
Texts are put together from their words by list takes,
and ``Table.group_by`` gives the block's partial document counts.  Spark adds
these, finds each A id's highest count and brings the counts back to the blocks.
Within a group, equal ids are folded before the join, so that a group of many
repeated tokens makes few rows; links carry their multiplicity.

Documents refer to their block's words by place, and words to its pairs; the
places and multiplicities are kept as byte planes, most of which are zero and
compress away.  Blocks are written to the shared folder before they are used
twice, so a lost executor costs no encoding done elsewhere.

Bounds: the table of highest counts has at most one row per A id; a task holds
one block's tokens (or those of one longer text).

Defined results: texts that are null, empty or not the same as the joined bytes
of both token lists have no tokens, zeros and an empty groups_sha256; special
strings are ordinary text; repeated rows each count as a document; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import ship, stage

NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
BATCH_IDS = 1 << 20  # blocks of one partition are numbered below this


# --- the two tokenizers ------------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it
    is printable in Latin-1, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE file.  Its ids are merge ranks, so they can be handed to an
    encoder of ranks, which has no special strings."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        alphabet = byte_alphabet()
        special = {t["id"] for t in described["added_tokens"]}
        held = {i: bytes(alphabet[c] for c in t) for t, i in described["model"]["vocab"].items() if i not in special}
        self.entries = pa.array([held.get(i, b"") for i in range(max(held) + 1)], pa.large_binary())
        self.lengths = pc.binary_length(self.entries).to_numpy()
        self.coding = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                        mergeable_ranks={b: i for i, b in held.items()})

    def encode(self, words: list[str]) -> pa.Array:
        """Token ids of every word behind a space.  Words without white space at their ends
        or spaces inside are encoded in one string and told apart by their bytes."""
        alone = [k for k, w in enumerate(words) if " " in w or w[0].isspace() or w[-1].isspace()]
        single = set(alone)
        common = [k for k in range(len(words)) if k not in single] if alone else range(len(words))
        ids = [self.coding.encode_to_numpy(" " + words[k], disallowed_special=()) for k in alone]
        text = "".join(" " + words[k] for k in common)
        found = self.coding.encode_to_numpy(text, disallowed_special=())
        ends = np.cumsum(self.lengths[found])
        bounds = np.cumsum([1 + len(words[k].encode()) for k in common], dtype=np.int64)
        stops = np.r_[0, np.searchsorted(ends, bounds) + 1] if len(bounds) else np.zeros(1, np.int64)
        every = lists(np.concatenate([found, *ids]), np.r_[np.diff(stops), [len(v) for v in ids]])
        return every.take(pa.array(np.argsort(np.r_[np.array(common, np.int64), np.array(alone, np.int64)]))) if alone else every


class Pieces:
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.entries = pa.array([
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)], pa.large_binary())
        #: no entry goes on over a space, so what stands before one does not change what follows
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, words: list[str]) -> pa.Array:
        """Token ids of every word behind a space."""
        return pa.array(self.model.encode(words, num_threads=1), pa.large_list(pa.int32()))


@lru_cache(maxsize=2)
def tokenizers(a_path: str, pattern: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a_path, pattern), Pieces(b_path)


# --- one block of texts --------------------------------------------------------------------------

def lists(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def same_bytes(words: list[str], ids: pa.Array, entries: pa.Array) -> np.ndarray:
    """Which words equal, behind a space, the joined bytes of their tokens."""
    taken = entries.take(pc.list_flatten(ids))
    ends = np.r_[0, pc.cumulative_sum(pc.cast(pc.binary_length(taken), pa.int64())).to_numpy(zero_copy_only=False)]
    stops = ends[ids.offsets.to_numpy()]
    data = bytes(taken.buffers()[2] or b"")[:int(stops[-1])]
    raw = [b" " + w.encode() for w in words]
    if data == b"".join(raw) and (np.diff(stops) == [len(w) for w in raw]).all():
        return np.ones(len(words), dtype=bool)
    stops = stops.tolist()
    return np.array([w == data[i:j] for w, i, j in zip(raw, stops, stops[1:], strict=False)], dtype=bool)


def emptied(ids: pa.Array, kept: np.ndarray) -> pa.Array:
    """The lists, those that are not kept without entries."""
    if kept.all():
        return ids
    lengths = np.diff(ids.offsets.to_numpy())
    return lists(pc.list_flatten(ids).to_numpy()[np.repeat(kept, lengths)], np.where(kept, lengths, 0))


class Side:
    """One tokenizer's tokens of a block's words: ids, word and end of each."""

    def __init__(self, ids: pa.Array, entries: pa.Array):
        self.ids = pc.list_flatten(ids)
        self.word = pc.list_parent_indices(ids).to_numpy()
        lengths = pc.cast(pc.binary_length(entries.take(self.ids)), pa.int64())
        ends = pc.cumulative_sum(lengths).to_numpy(zero_copy_only=False)
        before = np.r_[0, ends][ids.offsets.to_numpy()[:-1]]  # bytes of the words before
        self.end = ends - before[self.word]
    def table(self) -> pa.Table:
        return pa.table({"word": self.word, "end": self.end, "at": np.arange(len(self.end))})

    def cut(self, at: np.ndarray) -> None:
        """Group numbers, from the places of the tokens that end a group."""
        last = np.zeros(len(self.end), dtype=bool)
        last[at] = True
        self.stops = np.flatnonzero(last) + 1
        self.group = np.cumsum(last) - last

    def folded(self, many: np.ndarray, name: str) -> pa.Table:
        """group, id and how often it occurs there; equal ids are folded in the groups of ``many`` pairs."""
        big = many[self.group]
        own = pa.table({"group": self.group, name: self.ids, f"n_{name}": np.ones(len(self.group), dtype=np.int64)})
        if not big.any():
            return own
        fold = own.filter(pa.array(big)).group_by(["group", name], use_threads=False).aggregate([(f"n_{name}", "sum")])
        fold = fold.rename_columns({f"n_{name}_sum": f"n_{name}"}).select(own.column_names)
        return pa.concat_tables([own.filter(pa.array(~big)), fold])

    def spelled(self) -> pa.Array:
        """Each group's ids in decimal, joined by commas."""
        offsets = pa.array(np.r_[0, self.stops].astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.cast(self.ids, pa.string())), ",")


def planes(*columns: np.ndarray) -> bytes:
    """Unsigned 32-bit columns as byte planes: all lowest bytes first."""
    return b"".join(np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns)


def unplaned(data: bytes, columns: int) -> list[np.ndarray]:
    each = np.frombuffer(data, dtype=np.uint8).reshape(columns, 4, -1)
    return [np.ascontiguousarray(c.T).view("<u4").ravel().astype(np.int64) for c in each]


#: White space beyond the space, for a class of a pattern.
BLANKS = "\t\n\v\f\r\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def cut(texts: pa.Array, separable: bool) -> pa.Array:
    """The words of every text; a null or empty one has none."""
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    odd = np.ones(len(texts), dtype=bool) if not separable else pc.match_substring_regex(
        texts, f"^[ {BLANKS}]| [ {BLANKS}]|[{BLANKS}] | $").to_numpy(zero_copy_only=False)
    words = pc.split_pattern(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts), " ")
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    flat, n = pc.list_flatten(words), pc.list_value_length(words).to_numpy(zero_copy_only=False)
    flat = pc.replace_with_mask(flat, pa.array(np.repeat(odd, n)), texts.filter(pa.array(odd)))
    kept = np.repeat(~empty, n)
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(empty, 0, n))].astype(np.int64)),
                                         flat.filter(pa.array(kept)))


def aligned_words(words: list[str], a: ByteLevel, b: Pieces) -> tuple[dict[str, np.ndarray], pa.Array, pa.Table]:
    """Of different words: good (both token lists spell it), n_a, n_b, n_groups and n_links
    of each; its groups in decimal; and the folded links (word, a, b, times)."""
    ids = [side.encode(words) for side in (a, b)]
    good = np.ones(len(words), dtype=bool)
    for found, side in zip(ids, (a, b), strict=True):
        good &= same_bytes(words, found, side.entries)
    held = [emptied(found, good) for found in ids]
    left, right = (Side(h, side.entries) for h, side in zip(held, (a, b), strict=True))

    # shared ends: a hash join on (word, end)
    ends = left.table().join(right.table(), ["word", "end"], join_type="inner", right_suffix="_b", use_threads=False)
    left.cut(ends["at"].to_numpy())
    right.cut(ends["at_b"].to_numpy())
    word_of_group = left.word[left.stops - 1]
    product = np.diff(np.r_[0, left.stops]) * np.diff(np.r_[0, right.stops])

    # links: a hash join on the group; equal pairs of a word are folded
    many = product > 64
    pairs = left.folded(many, "a").join(right.folded(many, "b"), "group", join_type="inner", use_threads=False)
    pairs = pa.table({"word": word_of_group[pairs["group"].to_numpy()], "a": pairs["a"], "b": pairs["b"],
                      "times": pc.multiply(pairs["n_a"], pairs["n_b"])})
    pairs = pairs.group_by(["word", "a", "b"], use_threads=False).aggregate([("times", "sum")]).rename_columns(
        {"times_sum": "times"})
    groups = np.bincount(word_of_group, minlength=len(words))
    spelled = pc.binary_join_element_wise(left.spelled(), right.spelled(), "|")
    of_word = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(groups)].astype(np.int32)), spelled), ";")
    numbers = {"good": good, "n_a": pc.list_value_length(held[0]).to_numpy(), "n_b": pc.list_value_length(held[1]).to_numpy(),
               "n_groups": groups, "n_links": np.bincount(word_of_group, weights=product, minlength=len(words)).astype(np.int64)}
    return numbers, of_word, pairs


def folded_keys(doc: np.ndarray, other: np.ndarray) -> pa.Table:
    """Different (doc, other) and how often each occurs, in that order."""
    found = pa.table({"doc": doc, "other": other}).group_by(["doc", "other"], use_threads=False).aggregate(
        [([], "count_all")]).rename_columns({"count_all": "times"})
    order = np.lexsort((found["other"].to_numpy(), found["doc"].to_numpy()))
    return found.take(pa.array(order))


def align(texts: pa.Array, a: ByteLevel, b: Pieces) -> tuple[pa.Table, pa.Table, bytes]:
    """Of one block: its documents (n_a, n_b, n_groups, n_links, groups_sha256, links), its
    different pairs (a, b, docs: how many of these documents hold it), and its words' links.
    ``links`` of a document: places of its words as differences, and how often it has them;
    a word's links: places of its pairs in the block's list, and multiplicities."""
    words = cut(texts, b.separable)
    coded = pc.list_flatten(words).dictionary_encode()
    code, parent = coded.indices.to_numpy(), pc.list_parent_indices(words).to_numpy()
    numbers, spelled, pairs = aligned_words(coded.dictionary.to_pylist(), a, b)
    n = len(texts)
    bad = np.bincount(parent, weights=~numbers["good"][code], minlength=n) > 0  # such a text has no tokens at all
    kept = ~bad[parent]
    code, parent = code[kept], parent[kept]
    sums = {c: np.bincount(parent, weights=numbers[c][code], minlength=n).astype(np.int64) for c in NUMBERS}

    # the pairs of the block, and of each word by place
    held = pairs.group_by(["a", "b"], use_threads=False).aggregate([]).sort_by([("a", "ascending"), ("b", "ascending")])
    wide = [pc.add(pc.multiply(pc.cast(t["a"], pa.int64()), len(b.entries)), pc.cast(t["b"], pa.int64())) for t in (pairs, held)]
    place = np.searchsorted(wide[1].to_numpy(), wide[0].to_numpy())
    word = pairs["word"].to_numpy()
    order = np.lexsort((place, word))
    place, times = place[order], pairs["times"].to_numpy()[order]
    starts = np.searchsorted(word[order], np.arange(len(spelled) + 1))

    # the words of each document, and in how many documents a pair is
    own = folded_keys(parent, code)
    doc, of = own["doc"].to_numpy(), own["other"].to_numpy()
    bounds = np.searchsorted(doc, np.arange(n + 1))
    how_often = own["times"].to_numpy()
    links = [planes(np.diff(of[i:j], prepend=0), how_often[i:j]) for i, j in zip(bounds, bounds[1:], strict=False)]
    of_words = pa.LargeListArray.from_arrays(pa.array(starts.astype(np.int64)), pa.array(place)).take(pa.array(of))
    in_doc = folded_keys(doc[pc.list_parent_indices(of_words).to_numpy()], pc.list_flatten(of_words).to_numpy())
    docs = in_doc.group_by("other", use_threads=False).aggregate([([], "count_all")])
    counts = np.zeros(len(held), dtype=np.int64)
    counts[docs["other"].to_numpy()] = docs["count_all"].to_numpy()
    # pairs of words that only texts without tokens hold have a count of zero

    ranges = np.r_[0, np.cumsum(np.bincount(parent, minlength=n))].astype(np.int32)
    digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in pc.binary_join(
        pa.ListArray.from_arrays(pa.array(ranges), spelled.take(pa.array(code))), ";").to_pylist()]
    found = pa.table({**sums, "groups_sha256": pa.array(digests, pa.string()), "links": pa.array(links, pa.binary())})
    return found, held.append_column("docs", pa.array(counts)), planes(np.diff(word[order], prepend=0), place, times)


# --- all blocks ---------------------------------------------------------------------------------

def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to about ``most`` (one longer row is a run)."""
    if len(sizes):
        run = (np.cumsum(sizes) - sizes) // most
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        yield from zip(starts.tolist(), [*starts[1:].tolist(), len(sizes)], strict=True)


def blocks(docs: DataFrame, a_path: str, pattern: str, b_path: str, block_bytes: int) -> DataFrame:
    """One row per document (block, doc_id, its numbers and links) and one per block
    (block, pairs: its different pairs with their partial document counts)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"block long, doc_id {kind}, {', '.join(f'{n} long' for n in NUMBERS)}, groups_sha256 string, links binary, "
              "words binary, pairs array<struct<a:int,b:int,docs:long>>")
    pair = pa.struct({"a": pa.int32(), "b": pa.int32(), "docs": pa.int64()})

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(a_path, pattern, b_path)
        block = TaskContext.get().partitionId() * BATCH_IDS
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.fill_null(pc.cast(pc.binary_length(texts), pa.int64()), 0).to_numpy()
            for start, stop in slices(sizes, block_bytes):
                found, pairs, words = align(texts.slice(start, stop - start), a, b)
                n = len(found)
                own = {"block": pa.array(np.full(n, block)), "doc_id": batch.column("doc_id").slice(start, n),
                       **{c: found[c].combine_chunks() for c in found.column_names}}
                yield pa.RecordBatch.from_pydict({**own, "words": pa.nulls(n, pa.binary()), "pairs": pa.nulls(n, pa.list_(pair))})
                flat = pa.StructArray.from_arrays([pairs[c].combine_chunks() for c in ("a", "b", "docs")], fields=list(pair))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block]), **{c: pa.nulls(1, v.type) for c, v in own.items() if c != "block"},
                    "words": pa.array([words], pa.binary()),
                    "pairs": pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)})
                block += 1
                del found, pairs, words, own, flat
                pa.default_memory_pool().release_unused()  # else what one block took stays with the worker

    return docs.mapInArrow(of, schema)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Exact sums of the runs that begin at ``starts`` (which ends with the length)."""
    return np.diff(np.r_[0, np.cumsum(values)][starts])


def with_counts(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents, by the corpus-wide counts of its pairs (by place)."""
    step, place, times = unplaned(left["words"].drop_null()[0].as_py(), 3)
    word = np.cumsum(step)
    count, best = (np.zeros(int(place.max(initial=-1)) + 1, np.int64) for _ in range(2))
    at = right["place"].to_numpy()
    count[at], best[at] = right["n"].to_numpy(), pc.cast(right["is_best"], pa.int64()).to_numpy()
    starts = np.searchsorted(word, np.arange(int(word.max(initial=-1)) + 2))
    count, best = (segment_sums(times * c[place], starts) for c in (count, best))  # now by word
    docs = left.filter(left["links"].is_valid())
    step, often = (np.concatenate(c) if c else np.zeros(0, np.int64)
                   for c in zip(*(unplaned(x, 2) for x in docs["links"].to_pylist()), strict=True)) if len(docs) else ((), ())
    sizes = pc.cast(pc.divide(pc.binary_length(docs["links"]), 8), pa.int64()).to_numpy()
    starts = np.r_[0, np.cumsum(sizes)]
    before = np.r_[0, np.cumsum(step)]
    of = before[1:] - np.repeat(before[starts[:-1]], sizes)
    sums = [segment_sums(often * c[of], starts) for c in (best, count)]
    return docs.select(["doc_id", *NUMBERS]).append_column("n_best", pa.array(sums[0], pa.int64())).append_column(
        "count_sum", pa.array(sums[1], pa.int64())).append_column("groups_sha256", docs["groups_sha256"])


def alignments(docs: DataFrame, a_path: str, pattern: str, b_path: str, block_bytes: int = 1 << 20,
               doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(one row per row of ``docs`` with its numbers and groups_sha256; the corpus-wide
    counts: a, b, n, is_best)."""
    ship(docs.sparkSession)
    own = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    held = stage(blocks(own, a_path, pattern, b_path, block_bytes), "aligned-blocks")
    # where a block's pairs stand in its list
    words = held.where(F.col("pairs").isNotNull()).select("block", F.posexplode("pairs").alias("place", "pair")).select(
        "block", "place", "pair.a", "pair.b", "pair.docs").where("docs > 0")
    counts = words.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    counts = stage(counts, "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most one row per A id
    counts = counts.join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("is_best"))
    looked = words.join(counts, ["a", "b"]).select(F.col("block").alias("of"), "place", "n", "is_best")
    kind = own.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{n} long" for n in (*NUMBERS, "n_best", "count_sum"))
    out = held.drop("pairs").groupBy("block").cogroup(
        looked.groupBy("of")).applyInArrow(with_counts, f"doc_id {kind}, {numbers}, groups_sha256 string")
    return out, counts

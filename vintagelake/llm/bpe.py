"""Byte-pair encoding and decoding with the merges of a public tokenizer file.

``encode_documents`` adds ``n_tokens``, ``ids`` and (if asked) ``decoded`` to
every row.  A word's symbols form a doubly linked list; a priority queue holds
(rank, position) of each mergeable neighbour pair.  The lowest rank is merged
first, leftmost among equals; entries whose pair has changed since they were
pushed are stale and skipped, so one word costs O(n log n) whatever its length.

Defined results: a null or empty text has no ids and decodes to ''; special
token strings in a text become their own ids, as the library's default; a row
is encoded by itself, so repeated rows, ties and other columns play no part.
Columns of the input that share a name with an output column are replaced.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from vintagelake.llm.common import ship

# White space as Unicode lists it (the tokenizer file's \s); fixed values.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTROLS = regex.compile(r"[\x1c-\x1f]")


def unassigned() -> list[str]:
    """Characters that have no meaning in this Python's Unicode tables."""
    return [chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn"]


@lru_cache(maxsize=1)
def newer_tables() -> tuple[frozenset[str], dict[str, str]]:
    """Where the tokenizers library knows another Unicode than ``regex`` and Python: characters
    that are letters or digits to ``regex`` and not to it, and capitals that only it
    turns to lower case.  Both are among the characters unassigned here; the library
    is asked, as its tables are not published."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    spare = unassigned()
    doubted = regex.findall(r"[\p{L}\p{N}]", "".join(spare))
    pieces = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "isolated").pre_tokenize_str(f" {' '.join(doubted)} ")
    foreign = set(doubted) - {p for p, _ in pieces}
    lower = normalizers.Lowercase().normalize_str(" ".join(spare)).split(" ")
    return frozenset(foreign), {c: low for c, low in zip(spare, lower, strict=True) if c != low}


def byte_symbols() -> list[str]:
    """One printable character per byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    out, extra = [], 0x100
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def lower_each(text: str) -> str:
    """Lower case character by character (no rule for a final sigma)."""
    return text.replace("Σ", "σ").lower() if "Σ" in text else text.lower()


class RecentCache(dict):
    """Values by key, computed at first use.  Holds two generations of ``most``
    keys: when the young one is full, the old one is dropped and the young one
    takes its place, so that common keys stay and memory is bounded."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordBpe:
    """Encoder and decoder of a word-level BPE file with an end-of-word suffix."""

    def __init__(self, path: str, cache_words: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix: str = model.get("end_of_word_suffix") or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # a pair of neighbours is one number, left id * 2^32 + right id
        self.rank = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(merges)}
        self.merged = [vocab[a + b] for a, b in merges]  # by rank
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE))
        self.foreign, self.case = newer_tables()
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.first = [vocab[s] for s in byte_symbols()]
        self.last = [vocab[s + suffix] for s in byte_symbols()]
        self.word_ids = RecentCache(self.merge, cache_words).__getitem__
        self.chunk_ids = RecentCache(self.words_of_chunk, cache_words).__getitem__

    def merge(self, word: str) -> bytes:
        """The ids of one word after all merges, little-endian unsigned 32-bit."""
        data = word.encode("utf-8")
        sym = [self.first[b] for b in data]
        sym[-1] = self.last[data[-1]]
        n, rank = len(sym), self.rank.get
        if n > 1:
            before, after = list(range(-1, n - 1)), [*range(1, n), -1]
            queue = [r << 32 | i for i in range(n - 1) if (r := rank(sym[i] << 32 | sym[i + 1])) is not None]
            heapq.heapify(queue)
            while queue:
                r = heapq.heappop(queue)
                r, i = r >> 32, r & 0xFFFFFFFF
                j = after[i]
                if j < 0 or rank(sym[i] << 32 | sym[j]) != r:  # stale: a side has been merged meanwhile
                    continue
                sym[i] = self.merged[r]
                after[i] = k = after[j]
                sym[j] = after[j] = -1
                if k >= 0:
                    before[k] = i
                    if (r := rank(sym[i] << 32 | sym[k])) is not None:
                        heapq.heappush(queue, r << 32 | i)
                if (h := before[i]) >= 0 and (r := rank(sym[h] << 32 | sym[i])) is not None:
                    heapq.heappush(queue, r << 32 | h)
            sym = [s for s in sym if s >= 0]
        return struct.pack(f"<{len(sym)}I", *sym)

    def words(self, chunk: str) -> list[str]:
        if chunk.isascii() or self.foreign.isdisjoint(chunk):
            return self.split.findall(chunk)
        # in their place any character that is neither letter nor digit
        masked = "".join("\u2603" if c in self.foreign else c for c in chunk)
        return [chunk[m.start():m.end()] for m in self.split.finditer(masked)]

    def words_of_chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and not self.case.keys().isdisjoint(chunk):
            chunk = "".join(self.case.get(c, c) for c in chunk)
        return b"".join(map(self.word_ids, self.words(chunk)))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = [text] if self.specials is None or "<|" not in text else self.specials.split(text)
        out = []
        for part in parts:
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            else:
                part = lower_each(unicodedata.normalize("NFC", part))
                # no word holds white space; str.split also cuts at four controls that are none
                chunks = self.words(part) if CONTROLS.search(part) else part.split()
                out.extend(map(self.chunk_ids, chunks))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings one after the other, a space between (the file names no decoder)."""
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


@lru_cache(maxsize=2)
def codec(path: str) -> WordBpe:
    """One codec, with its word cache, per Python worker."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text", decode: bool = True) -> DataFrame:
    """Every row of ``docs`` with n_tokens (long), ids (binary: little-endian
    unsigned 32-bit) and decoded (string; null if ``decode`` is False)."""

    ship(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids binary, decoded string")
    def encoded(texts: pd.Series) -> pd.DataFrame:
        bpe = codec(tokenizer)
        ids = [bpe.encode(t) for t in texts]
        return pd.DataFrame({
            "n_tokens": [len(i) // 4 for i in ids],
            "ids": ids,
            "decoded": [bpe.decode(i) if decode else None for i in ids],
        })

    own = [c for c in docs.columns if c.lower() not in ("n_tokens", "ids", "decoded", "__bpe")]
    out = docs.select(*[docs[c] for c in own], encoded(F.coalesce(docs[text], F.lit(""))).alias("__bpe"))
    return out.select(*own, "__bpe.n_tokens", "__bpe.ids", "__bpe.decoded")


def digest(encoded: DataFrame) -> DataFrame:
    """The digest columns of the contract, from the operator's output."""
    return encoded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )

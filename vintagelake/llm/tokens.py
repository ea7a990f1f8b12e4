"""Token counts of a document's sections by offset-mapped attribution.

Whole texts are encoded once with a byte-level vocabulary.  Its tokens' bytes
follow one another in the text, so running sums of their lengths give every
token's character span.  Spans and sections are then joined on overlap: both
are sorted and the sections do not overlap, so two binary searches per token
find the sections of its first and of its last character.

A token that crosses a boundary is allocated by ``rule``:
``start``: to the section of its first character that lies in any section;
``majority``: to the section with most of its characters, the earlier if equal;
``share``: to each section in proportion to its characters there.
A token of which no character lies in a section counts for the document only.
A character cut by a token boundary counts to the token that has its first byte,
and a token without a first byte is placed at the character it goes on.

Defined results: a null or empty text has no tokens and no sections of its own
making; special strings are ordinary text; empty sections get no tokens;
repeated rows are counted each.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import ship

RULES = ("start", "majority", "share")
COUNTS = ("n_tokens long, sections array<struct<section:int,start:int,stop:int,n_tokens:double,n_crossing:int>>")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding and the byte length of every id."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, i in ranks.items():
        lengths[i] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (one past the last) of every token, in code points."""
    coding, lengths = encoder(path, pattern)
    ids = coding.encode_to_numpy(text, disallowed_special=())
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    ends = np.cumsum(lengths[ids])
    begins = ends - lengths[ids]
    if len(data) == len(text):
        return begins, ends
    heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # characters begun before each byte
    first, stop = heads[begins], heads[ends]
    # a token of continuation bytes only lies at the character before
    inside = first == stop
    return np.where(inside, first - 1, first), stop


def attribute(first: np.ndarray, stop: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section (sorted, disjoint spans lo..hi) and how many of its tokens also lie outside it."""
    n = len(lo)
    count, crossing = np.zeros(n), np.zeros(n, dtype=np.int64)
    if not n or not len(first):
        return count, crossing
    left = np.searchsorted(hi, first, side="right")  # first section that ends after the token begins
    right = np.searchsorted(lo, stop, side="left") - 1  # last section that begins before the token ends
    touched = np.maximum(right - left + 1, 0)
    token = np.repeat(np.arange(len(first)), touched)
    section = np.repeat(left, touched) + np.arange(len(token)) - np.repeat(np.cumsum(touched) - touched, touched)
    common = np.minimum(stop[token], hi[section]) - np.maximum(first[token], lo[section])
    token, section, common = token[common > 0], section[common > 0], common[common > 0]
    np.add.at(crossing, section[common < (stop - first)[token]], 1)
    if rule == "share":
        whole = np.zeros(len(first))
        np.add.at(whole, token, common)
        np.add.at(count, section, common / whole[token])
        return count, crossing
    order = np.lexsort((section, -common, token) if rule == "majority" else (section, token))
    token, section = token[order], section[order]
    chosen = np.r_[True, token[1:] != token[:-1]] if len(token) else np.zeros(0, dtype=bool)
    np.add.at(count, section[chosen], 1)
    return count, crossing


def paragraphs(text: str) -> list[tuple[int, int]]:
    """Spans of a text's lines that hold anything but white space."""
    return [(m.start(), m.end()) for m in regex.finditer(r"[^\n]*\S[^\n]*", text)]


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, rule: str = "majority", text: str = "text",
                 sections: str | None = None) -> DataFrame:
    """Every row of ``docs`` with n_tokens (of the whole text) and sections: one
    struct per section with its span, tokens and boundary-crossing tokens.

    ``sections`` names a column of array<struct<start:int,stop:int>> of sorted,
    disjoint code point spans; without it the text's lines are the sections.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship(docs.sparkSession)

    def one(t: str, spans) -> dict:
        first, stop = token_spans(t, vocabulary, pattern)
        spans = paragraphs(t) if spans is None else [(s["start"], s["stop"]) for s in spans]
        lo, hi = (np.array([s[i] for s in spans], dtype=np.int64) for i in (0, 1))
        count, crossing = attribute(first, stop, lo, hi, rule)
        return {"n_tokens": len(first), "sections": [
            {"section": i, "start": a, "stop": b, "n_tokens": c, "n_crossing": x}
            for i, (a, b, c, x) in enumerate(zip(lo.tolist(), hi.tolist(), count.tolist(), crossing.tolist(), strict=True))]}

    own = [c for c in docs.columns if c.lower() not in ("n_tokens", "__counts", "sections")]
    body = F.coalesce(docs[text], F.lit(""))
    if sections is None:
        @F.pandas_udf(COUNTS)
        def counted(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(t, None) for t in texts], columns=["n_tokens", "sections"])

        out = counted(body)
    else:
        @F.pandas_udf(COUNTS)
        def counted_in(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(t, () if s is None else s) for t, s in zip(texts, spans, strict=True)],
                                columns=["n_tokens", "sections"])

        out = counted_in(body, docs[sections])
    return docs.select(*[docs[c] for c in own], out.alias("__counts")).select(
        *own, "__counts.n_tokens", "__counts.sections")


def count_fields(docs: DataFrame, fields: list[str], vocabulary: str, pattern: str, rule: str = "majority",
                 separator: str = "\n") -> DataFrame:
    """Every row of ``docs`` with n_tokens (of its fields joined by ``separator``, encoded
    once) and field_tokens, a map from each field's name to its share of them.

    A null field is empty; an empty one has 0 tokens.  Tokens that hold nothing but
    separators count for the row only.
    """
    texts = [F.coalesce(docs[f].cast("string"), F.lit("")) for f in fields]
    spans, at = [], F.lit(0)
    for text in texts:
        stop = at + F.char_length(text)
        spans.append(F.struct(at.alias("start"), stop.alias("stop")))
        at = stop + F.lit(len(separator))
    own = [c for c in docs.columns if c.lower() not in ("n_tokens", "field_tokens", "__fields")]
    joined = docs.select(F.struct(*[docs[c] for c in own]).alias("__fields"), F.concat_ws(separator, *texts).alias("text"),
                         F.array(*spans).alias("spans"))
    counted = count_tokens(joined, vocabulary, pattern, rule, sections="spans")
    by_field = F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.transform("sections", lambda s: s["n_tokens"]))
    return counted.select("__fields.*", "n_tokens", by_field.alias("field_tokens"))


def per_section(counted: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per section; a document without sections has one row with a null section."""
    return counted.select(F.col(doc_id).alias("doc_id"), F.col("n_tokens").alias("doc_tokens"),
                          F.explode_outer("sections").alias("s")).select("doc_id", "doc_tokens", "s.*")

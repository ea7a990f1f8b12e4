import random

import numpy as np
import public_tokenizers
import pytest

from tests.llm.conftest import make_docs
from vintagelake.llm import tokens
from vintagelake.llm.queries import BYTE_BPE


def brute(first, stop, spans, rule):
    count, crossing = [0.0] * len(spans), [0] * len(spans)
    for a, b in zip(first, stop, strict=True):
        common = [max(0, min(b, y) - max(a, x)) for x, y in spans]
        for i, c in enumerate(common):
            crossing[i] += 0 < c < b - a
        if not sum(common):
            continue
        if rule == "share":
            for i, c in enumerate(common):
                count[i] += c / sum(common)
        elif rule == "majority":
            count[max(range(len(common)), key=lambda i: (common[i], -i))] += 1
        else:
            count[next(i for i, c in enumerate(common) if c)] += 1
    return count, crossing


@pytest.mark.parametrize("rule", tokens.RULES)
def test_attribution_against_brute_force(rule):
    rnd = random.Random(0)
    for _ in range(400):
        text = "".join(rnd.choice("ab é\n😀x 日") for _ in range(rnd.randrange(40)))
        first, stop = tokens.token_spans(text, BYTE_BPE, public_tokenizers.PATTERN)
        cuts = sorted(rnd.sample(range(len(text) + 1), min(len(text) + 1, 2 * rnd.randrange(4)) // 2 * 2))
        spans = [(cuts[i], cuts[i + 1]) for i in range(0, len(cuts), 2)]
        lo, hi = (np.array([s[i] for s in spans], dtype=np.int64) for i in (0, 1))
        count, crossing = tokens.attribute(first, stop, lo, hi, rule)
        want = brute(first.tolist(), stop.tolist(), spans, rule)
        assert np.allclose(count, want[0]) and crossing.tolist() == want[1]


def test_spans_are_the_librarys():
    coding, _ = tokens.encoder(BYTE_BPE, public_tokenizers.PATTERN)
    for text in ("plain words, 12!", "héllo wörld 日本語\nx 😀😀", "a" * 3000, " \n \n", "<|endoftext|>", "x"):
        first, _ = tokens.token_spans(text, BYTE_BPE, public_tokenizers.PATTERN)
        assert first.tolist() == coding.decode_with_offsets(coding.encode_ordinary(text))[1]


def test_operator(odd, odd_rows):
    got = tokens.count_tokens(odd, BYTE_BPE, public_tokenizers.PATTERN).collect()
    assert len(got) == len(odd_rows)
    coding, _ = tokens.encoder(BYTE_BPE, public_tokenizers.PATTERN)
    texts = {(r[0], len(coding.encode_ordinary(r[1] or ""))) for r in odd_rows}
    assert {(r["doc_id"], r["n_tokens"]) for r in got} == texts
    assert all(sum(s["n_tokens"] for s in r["sections"]) <= r["n_tokens"] for r in got)


def test_given_sections(spark):
    df = spark.createDataFrame([(1, "alpha beta", [(0, 3), (3, 10)]), (2, "alpha", None), (3, None, [(0, 0)])],
                               "doc_id long, text string, sections array<struct<start:int,stop:int>>")
    out = {r["doc_id"]: r for r in tokens.count_tokens(df, BYTE_BPE, public_tokenizers.PATTERN, sections="sections").collect()}
    assert sum(s["n_tokens"] for s in out[1]["sections"]) == out[1]["n_tokens"]
    assert out[2]["sections"] == [] and out[2]["n_tokens"] > 0
    assert out[3]["n_tokens"] == 0
    rows = tokens.per_section(tokens.count_tokens(df, BYTE_BPE, public_tokenizers.PATTERN, sections="sections")).count()
    assert rows == 4


def test_empty_table_and_wrong_rule(none):
    assert tokens.per_section(tokens.count_tokens(none, BYTE_BPE, public_tokenizers.PATTERN)).count() == 0
    with pytest.raises(ValueError):
        tokens.count_tokens(none, BYTE_BPE, public_tokenizers.PATTERN, rule="other")


@pytest.mark.parametrize("rule", tokens.RULES)
def test_fields_of_a_row_from_one_encoding(spark, odd, odd_rows, rule):
    """Against every token's characters counted one by one."""
    coding, _ = tokens.encoder(BYTE_BPE, public_tokenizers.PATTERN)
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 5000]
    docs = make_docs(spark, rows)
    got = tokens.count_fields(docs, ["text", "lang", "source"], BYTE_BPE, public_tokenizers.PATTERN, rule).collect()
    assert len(got) == len(rows) and "fp" in got[0].asDict()
    for r in got:
        parts = [r[f] or "" for f in ("text", "lang", "source")]
        joined = "\n".join(parts)
        ids = coding.encode_ordinary(joined)
        assert r["n_tokens"] == len(ids)
        field_of, at = [], 0
        for k, part in enumerate(parts):
            field_of += [k] * len(part) + [None] * (k < 2)
        want, at, data = [0.0] * 3, 0, joined.encode()
        for i in ids:
            piece = coding.decode_single_token_bytes(i)
            first = len(data[:at].decode(errors="ignore")) if at else 0
            stop = len(data[:at + len(piece)].decode(errors="ignore"))
            at += len(piece)
            own = [field_of[c] for c in range(first, max(stop, first + 1)) if c < len(field_of) and field_of[c] is not None]
            if not own:
                continue
            if rule == "share":
                for k in own:
                    want[k] += 1 / len(own)
            else:
                k = own[0] if rule == "start" else max(sorted(set(own)), key=own.count)
                want[k] += 1
        if joined.isascii():
            assert [r["field_tokens"][f] for f in ("text", "lang", "source")] == pytest.approx(want)
        assert sum(r["field_tokens"].values()) <= len(ids) + 1e-9

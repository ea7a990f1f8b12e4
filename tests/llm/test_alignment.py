import hashlib
import random
from bisect import bisect_right
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import make_docs, prose
from vintagelake.llm import alignment
from vintagelake.llm.queries import BYTE_BPE_JSON, PIECE_BPE

ODD = ["", None, " ", "  ", "a", " lead", "trail ", "two  spaces", "tab\t x", "x \n y", "\n \n \n", "a\n b", "a \nb", "\nnew", "end\n",
       "▁under ▁▁ line", "<|endoftext|> is plain <s></s> <unk>", "ﬁne Ａ é", "\x00nul", "x  y  z", "😀😀 👩‍👩‍👧 ok",
       "word", "word word word", "don't we'll I'M", "日本語 の テキスト", "=" * 700, "ab" * 400, "\U000e0001 tag", "a\x85b c", "१२३ ٣٤"]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(BYTE_BPE_JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def entries(a, b):
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in printable}
    letters |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in printable)}
    left = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}
    right = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        right[i] = bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
    return left, right


def groups(text, a, b, spelled):
    """The groups of a text, as two lists of ids each, from whole-text encodings."""
    if not text:
        return []
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    ends = []
    for side, found in zip(spelled, ids, strict=True):
        if b"".join(side[i] for i in found) != (" " + text).encode():
            return []
        at, own = 0, []
        for i in found:
            at += len(side[i])
            own.append(at)
        ends.append(own)
    shared, out, before = sorted(set(ends[0]) & set(ends[1])), [], 0
    for stop in shared:
        out.append(tuple(found[bisect_right(own, before):bisect_right(own, stop)] for found, own in zip(ids, ends, strict=True)))
        before = stop
    return out


def by_definition(texts, a, b):
    spelled = entries(a, b)
    cut = [groups(t, a, b, spelled) for t in texts]
    links = [Counter((x, y) for left, right in g for x in left for y in right) for g in cut]
    count = Counter(pair for own in links for pair in own)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for g, own in zip(cut, links, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()),
                    sum(n for p, n in own.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in own.items()),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block_bytes", [6 << 20, 300])
def test_against_whole_encodings(spark, both, block_bytes):
    rnd = random.Random(8)
    alphabet = [" ", " ", "\n", "\t", " ", "a", "the", "Ünï", "7", "42", "!", "...", "▁", "😀", "é", "中", "'s"]
    texts = ODD + [prose(rnd, rnd.randrange(1, 60)) for _ in range(40)] + [prose(rnd, 8_000)]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 40))) for _ in range(300)] + [texts[-1], texts[-1]]
    rows = [(i if i % 9 else None, t, "en", "a") for i, t in enumerate(texts)]
    found, _ = alignment.alignments(make_docs(spark, rows), BYTE_BPE_JSON, P.PATTERN, PIECE_BPE, block_bytes=block_bytes)
    want = by_definition(texts, *both)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in found.collect()), key=key)
    assert got == sorted(((r[0], *w) for r, w in zip(rows, want, strict=True)), key=key)


def test_every_letter_alike_in_both_encoders(both):
    """The ranks' encoder gives the ids of the library that reads the same file."""
    own, _ = alignment.tokenizers(BYTE_BPE_JSON, P.PATTERN, PIECE_BPE)
    texts = [f"a{chr(c)}b1{chr(c)} {chr(c)}{chr(c)}!{chr(c)}\n{chr(c)}  {chr(c)} x" for c in range(1, 0x30000, 7)
             if not 0xD800 <= c < 0xE000]
    want = both[0].encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    assert own.encode(texts).to_pylist() == [e.ids for e in want]


def test_words_encoded_together_are_those_encoded_alone(both):
    a, b = alignment.tokenizers(BYTE_BPE_JSON, P.PATTERN, PIECE_BPE)
    assert b.separable
    texts = ["plain words here", "plain  gap", "\nplain", "words \n x", "", None, "one", "line\nline two"]
    cut = alignment.cut(pa.array(texts), True).to_pylist()
    assert cut == [["plain", "words", "here"], ["plain  gap"], ["\nplain"], ["words \n x"], [], [], ["one"], ["line\nline", "two"]]
    assert alignment.cut(pa.array(texts), False).to_pylist() == [[t] if t else [] for t in texts]


def test_a_group_of_many_equal_tokens_makes_few_links(both):
    a, b = alignment.tokenizers(BYTE_BPE_JSON, P.PATTERN, PIECE_BPE)
    word = "ab" * 5000
    numbers, _, pairs = alignment.aligned_words([word], a, b)
    assert numbers["n_links"][0] == sum(pairs["times"].to_pylist()) and len(pairs) < 200


def test_planes_round_trip():
    import numpy as np

    x, y = np.array([0, 1, 255, 256, 2**32 - 1]), np.array([5, 4, 3, 2, 1])
    back = alignment.unplaned(alignment.planes(x, y), 2)
    assert back[0].tolist() == x.tolist() and back[1].tolist() == y.tolist()
    assert [c.tolist() for c in alignment.unplaned(b"", 2)] == [[], []]


def test_empty_table_and_clashing_names(spark, none, odd, odd_rows):
    found, counts = alignment.alignments(none, BYTE_BPE_JSON, P.PATTERN, PIECE_BPE)
    assert found.count() == 0 and counts.count() == 0
    found, counts = alignment.alignments(odd, BYTE_BPE_JSON, P.PATTERN, PIECE_BPE)
    assert found.count() == len(odd_rows) and counts.where("is_best").select("a").distinct().count() == counts.select("a").distinct().count()

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from vintagelake.llm import bpe
from vintagelake.llm.queries import WORD_BPE


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_and_decoded_text_are_the_librarys(spark, odd, odd_rows, library):
    got = bpe.digest(bpe.encode_documents(odd, WORD_BPE)).collect()
    want = []
    for doc_id, text, *_ in odd_rows:
        e = library.encode(text or "", add_special_tokens=False)
        want.append((doc_id, len(e.ids), hashlib.sha256(np.array(e.ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_unusual_texts(library):
    own = bpe.WordBpe(WORD_BPE)
    rnd = random.Random(1)
    texts = ["", " ", "ΑΣ ΟΔΟΣ", "İstanbul", "don't WE'LL <|endoftext|>x<|startoftext|>", "\x1c\x1da b\x85c\xa0d",
             "a" * 5000, "½ ①", "<|endoftext|", "ſ's", "ﬁ ǅ"]
    texts += ["".join(rnd.choice("aB1 é'.\tΣß日😀") for _ in range(rnd.randrange(60))) for _ in range(400)]
    for t in texts:
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t
        assert own.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_cache_stays_bounded():
    own = bpe.WordBpe(WORD_BPE, cache_words=10)
    first = [own.encode(f"word{i} and") for i in range(100)]
    assert first == [own.encode(f"word{i} and") for i in range(100)]


def test_empty_table(none):
    assert bpe.encode_documents(none, WORD_BPE).count() == 0


def test_other_columns_stay(odd):
    out = bpe.encode_documents(odd, WORD_BPE)
    assert {"doc_id", "lang", "fp", "size"} <= set(out.columns)
    assert out.columns.count("n_tokens") == 1


def test_every_code_point_is_split_as_the_library_does(library):
    own = bpe.WordBpe(WORD_BPE)
    points = [c for c in range(1, 0x33500) if not 0xD800 <= c < 0xE000] + list(range(0xE0000, 0xE0200))
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in points]
    wrong = []
    for i in range(0, len(texts), 20_000):
        want = library.encode_batch_fast(texts[i:i + 20_000], add_special_tokens=False)
        wrong += [hex(points[i + k]) for k, e in enumerate(want)
                  if np.frombuffer(own.encode(texts[i + k]), "<u4").tolist() != e.ids]
    assert not wrong

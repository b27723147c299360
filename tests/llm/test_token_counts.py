import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textlake.llm.token_counts import Vocabulary, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


def test_matches_library_on_random_text(lib):
    v, rng = Vocabulary(PATH), random.Random(7)
    alphabet = ["a", "b", "e", "the", "ing", " ", "  ", "\n", "\t", "'s", "'ll", "'", "é", "é", "ß", "Σ", "ΑΣ", "İ", "1", "２", "½", "😀", "‍", "漢字", "\x00", "\x1c", "\x85", "\xa0", " ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "!!!", "???", "_", "A", "Z", "ﬁ", "́"]
    for _ in range(3000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert v.count(s) == lib(s), repr(s)


def test_long_word_and_ties(lib):
    v = Vocabulary(PATH)
    for s in ("a" * 5000, "ab" * 3000, "tion" * 2000, "é" * 1500):
        assert v.count(s) == lib(s)


def test_rows(spark, lib):
    rows = [(1, "Hello, World", "x"), (1, "Hello, World", "x"), (2, None, None), (3, "", "y"), (None, "a " * 3000, "z")]
    out = count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PATH).collect()
    assert sorted(r.n_tokens_ or "" for r in out) == ["", "x", "x", "y", "z"]
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in out) == sorted((len((t or "").encode()), lib(t or ""), lib(t or "") > 2048) for _, t, _ in rows)
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0

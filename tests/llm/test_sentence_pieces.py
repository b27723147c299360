import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from textlake.llm import sentence_pieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", "ing", " ", "  ", " " * 17, "\n", "\t", "▁", "\x00", "é", "é", "漢字", "😀", "​", "�", "﻿", "<s>", "</s>", "<unk>", "<0x0A>", "\r", "\x85", "\xa0", "ß", "Σ", "0", "12", "!!!", "==", "\U0010ffff", "﷐", "שלום", "हि"]


@pytest.fixture(scope="module")
def lib():
    return S.library(PATH)


def test_encoding_and_decoding_match_the_library(lib):
    p, rng = S.Pieces(PATH), random.Random(7)
    for k in range(4000):
        t = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20)))
        ids = np.frombuffer(p.encode(t), np.int32).tolist()
        assert ids == lib.encode(t), repr(t)
        assert p.decode(ids) == lib.decode(ids), repr(t)
    p.check()


def test_decoding_any_ids(lib):
    p, rng = S.Pieces(PATH), random.Random(8)
    odd = [0, 1, 2, 259, 3 + 0xE2, 3 + 0x96, 3 + 0x81, 3 + 0xED, 3 + 0xA0]
    for k in range(6000):
        ids = [rng.choice([*odd, rng.randint(3, 258), rng.randint(131, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 8))]
        assert p.decode(ids) == lib.decode(ids), ids


def test_long_chunks_and_ties(lib):
    p = S.Pieces(PATH)
    for t in ("a" * 20_000, "ab" * 9_000, " " * 5_000, "漢" * 3_000, "\n" * 3_000, "tion" * 5_000):
        assert np.frombuffer(p.encode(t), np.int32).tolist() == lib.encode(t)


def test_equal_scores_merge_leftmost_in_chunks_of_both_kinds(monkeypatch):
    p, rng = S.Pieces(PATH), random.Random(10)
    rank = {w: (r >> S.PLACE_BITS[0]) // 3000 for w, r in p.ranks[0].items()}
    monkeypatch.setattr(p, "ranks", [{w: r << bits for w, r in rank.items()} for bits in S.PLACE_BITS])
    chunks = [" " + "".join(rng.choice("etaoins漢é") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    want = []
    for c in chunks:
        symbols = list(c)
        while best := min(((rank[x + y], k) for k, (x, y) in enumerate(zip(symbols, symbols[1:])) if x + y in rank), default=None):
            symbols[best[1] : best[1] + 2] = ["".join(symbols[best[1] : best[1] + 2])]
        want.append(b"".join(p.packed.get(x) or np.array([p.byte[b] for b in x.encode()], np.int32).tobytes() for x in symbols))
    assert [p.agenda(c) for c in chunks] == want
    monkeypatch.setattr(S, "PLACE_BITS", (0, S.PLACE_BITS[1]))
    assert [p.agenda(c) for c in chunks] == want


def test_ids_leave_arrow_a_row_at_a_time():
    rows = pa.array([None, [], [1, 2, 3], None, [4], []], pa.list_(pa.int32()))
    assert list(S.lists(rows)) == rows.to_pylist() and list(S.lists(rows[2:5])) == rows[2:5].to_pylist() and list(S.lists(rows[:0])) == []
    long = pa.array([list(range(32_000))] * 10, pa.list_(pa.int32()))

    def least(run):
        took = []
        for _ in range(5):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    assert least(lambda: list(S.lists(long))) < least(long.to_pylist) / 2


def test_a_difference_is_an_error():
    p = S.Pieces(PATH)
    p.encode("some words")
    p.fresh[0] = (p.fresh[0][0], b"\0\0\0\0")
    with pytest.raises(ValueError, match="differ"):
        p.check()


def test_chunks_leave_both_generations_of_the_cache(monkeypatch, lib):
    monkeypatch.setattr(S, "CACHED_CHUNKS", 10)
    p, rng = S.Pieces(PATH), random.Random(9)
    for _ in range(500):
        t = " ".join(rng.choice(["one", "two", "three", "four", "five", "six", "seven", "eight"]) for _ in range(5))
        assert np.frombuffer(p.encode(t), np.int32).tolist() == lib.encode(t)
        assert len(p) <= 5 and len(p.older) <= 5


def test_rows(spark, lib):
    rows = [(1, "Hello, World\n", "x"), (1, "Hello, World\n", "x"), (2, None, None), (3, "", "y"), (None, "a " * 30_000, "z")]
    out = S.decode(S.encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids_", "ids", "n_tokens", "decoded"]
    got = sorted(((r.doc_id or 0), r.ids, r.n_tokens, r.decoded, r.ids_ or "") for r in out.collect())
    want = sorted(((d or 0), lib.encode(t or ""), len(lib.encode(t or "")), t or "", x or "") for d, t, x in rows)
    assert got == want
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.decode(S.encode(none, PATH), PATH).count() == 0
    assert S.decode(spark.createDataFrame([(None, "q")], "ids array<int>, decoded string"), PATH).first() == (None, "q", None)


def test_query_against_the_library(spark, sf, lib):
    got = {r.doc_id: r for r in S.query(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs:
        ids = lib.encode(d.text or "")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))

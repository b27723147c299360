import hashlib
import random

import public_tokenizers as P

from textlake.llm import chat_format as C

PATH = P.path("byte_bpe_50k.tiktoken")


def test_escape_round_trip_and_no_control_string_left():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice(["\\", "#", "###", "</turn>", "</", "turn>", " ", "a", "\n", ": ", "é"]) for _ in range(rng.randint(0, 14)))
        e = C.escape(t)
        assert C.unescape(e) == t
        for c in C.CONTROL:
            assert all((len(e[:i]) - len(e[:i].rstrip("\\"))) % 2 for i in range(len(e)) if e.startswith(c, i))


def test_turn_round_trip_and_mask():
    enc = C.encoding(PATH, P.PATTERN)
    for role, text in (("user", "hi"), ("assistant", r"\### Assistant: </turn> ok"), ("", ""), ("assistant", ""), ("assistant", "<|endoftext|> é😀\x00"), ("a: b\n", "x" * 5000)):
        ids, mask = C.assemble(enc, role, text, role == "assistant")
        assert len(ids) == len(mask) and (ids >= C.OPEN).sum() == 3
        got = C.read_turn(enc, ids, mask)
        assert got[:3] == (role, text, text if role == "assistant" else "")


def test_digests_against_plain_python(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 30), rng.randint(0, 6), rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "é\n", "### x", "\\", "</turn>"]) * rng.randint(1, 3) if rng.random() < 0.9 else None) for _ in range(300)]
    rows = [(c, t, r, x) for c, t, r, x in rows] + [(99, None, "assistant", "b"), (99, 0, "assistant", "a"), (None, 1, "user", "q"), (77, 1, "assistant", "z" * 200_000)] + [(55, i, "assistant", f"t{i} ") for i in range(3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: r for r in C.digests(C.format_turns(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()}
    first = lambda x: (x is not None, x if x is not None else 0)
    by = {}
    for c, t, r, x in sorted(rows, key=lambda z: (first(z[1]), z[2] is not None, z[2] or "", z[3] is not None, (z[3] or "").encode())):
        by.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(C.escape(r)) + len(C.escape(x)) + 15 for r, x in turns)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.digests(C.format_turns(none, PATH, P.PATTERN), PATH, P.PATTERN).count() == 0

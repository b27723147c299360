import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from textlake.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Cost and letters by trying every path: (symbol, initial, truncated) a row, insertions before each."""
    best = {}

    def go(i, roles, cost, letters):
        if cost > 3 + 4 * len(rows) + 6 or len(roles) > 2 * len(rows) + 2:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best.setdefault(cost, set()).add(letters)
        if roles == "" or re.fullmatch("s?(ua)*u?", roles):
            for r in "ua":
                if re.fullmatch("s?(ua)*u?", roles + r):
                    go(i, roles + r, cost + 3, letters + "I") if letters[-2:] != "II" else None
        if i < len(rows):
            bad, initial, truncated = rows[i]
            go(i + 1, roles, cost + 4, letters + "D")
            if not bad:
                for letter, r, c in (("K", initial, 0), ("R", "u", 3), ("R", "a", 3)):
                    if re.fullmatch("s?(ua)*u?", roles + r):
                        go(i + 1, roles + r, cost + c + 3 * truncated, letters + letter)

    go(0, "", 0, "")
    least = min(best)
    return least, min(best[least])


def test_every_short_conversation():
    kinds = [(True, "u", 0), *[(False, i, t) for i in "suax" for t in (0, 1)]]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            r = C.Repair(1)
            r.symbols = bytearray(0 if bad else 1 + 2 * "suax".index(i) + t for bad, i, t in rows)
            letters = "".join(e[0] for _, i, _ in rows for e in r.edits(i, "")) + "".join(e[0] for e in r.end())
            assert (r.cost, letters) == cheapest(rows), rows


def test_the_automaton_stays_small():
    rng = random.Random(1)
    a = C.Automaton()
    for _ in range(2000):
        a.scan(bytearray(rng.randrange(9) for _ in range(rng.randint(0, 40))))
    assert len(a.vectors) < 200
    assert all(min(v) == 0 for v in a.vectors)


def plain(turns, damage=True):
    """All of a table's reports, from the definition."""
    out, blank_chars = {}, re.compile(r"[^\x20\x09-\x0D]")
    by = {}
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        rows = by.setdefault(conv, [])
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:40].encode(), hashlib.md5((r[1].encode().hex().upper() + " " + r[2]).encode()).hexdigest()))
        seen, symbols, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            ink = blank_chars.findall(text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            symbols.append((fault in ("blank", "duplicate"), role[:1] if role[:1] in ("s", "u", "a") else "x", int(fault == "truncated")))
        # forward, by cost and letters a state; letters sort alike behind equal ones
        steps = {"": "su", "s": "u", "u": "a", "a": "u"}
        full = {"": {(0, "", ())}}

        def spread(full):
            for _ in range(3):
                for q, ways in list(full.items()):
                    r = steps[q][-1]
                    full.setdefault(r, set()).update((c + 3, e + "I", (*m, "user:" if r == "u" else "assistant:")) for c, e, m in ways if not e.endswith("II"))
            return {q: {w for w in ways if w[0] == min(ways)[0]} | {min(ways)} for q, ways in full.items()}

        for (bad, initial, truncated), (_, role, text) in zip(symbols, rows):
            full, after = spread(full), {}
            for q, ways in full.items():
                for c, e, m in ways:
                    after.setdefault(q, set()).add((c + 4, e + "D", m))
                    if not bad:
                        if initial in steps[q]:
                            after.setdefault(initial, set()).add((c + 3 * truncated, e + "K", (*m, f"{role}:{text}")))
                        r = steps[q][-1]
                        after.setdefault(r, set()).add((c + 3 + 3 * truncated, e + "R", (*m, f"{'user' if r == 'u' else 'assistant'}:{text}")))
            full = {q: {min(w for w in ways if w[0] == min(ways)[0])} for q, ways in after.items()}
        ends = [w for q, ways in spread(full).items() if q in ("", "a") for w in ways]
        cost, audit, made = min(ends)
        numbers = [t for t, _, _ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def random_turns(rng, n):
    texts = ["Yes.", "no", " \t", "", "What?", "What? \n", "end.\xa0", "é!", None, "same text.", "same text."]
    return [(rng.choice([None, *range(40)]), rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice(texts)) for _ in range(n)]


def test_against_plain_python(spark):
    rng = random.Random(5)
    rows = random_turns(rng, 500) + [(77, i, "user" if i % 2 else "assistant", f"text {i}.") for i in range(3000)] + [(78, 3, "user", "again.")] * 200 + [(79, 0, "user", "x" * 300_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], f"{SCHEMA}, audit string")
    got = {r.conv_id: tuple(r)[1:] for r in C.reports(C.damaged(df)).collect()}
    assert got == plain(rows)
    assert C.reports(C.damaged(df.limit(0))).count() == 0


def test_conversations_without_rows(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    out = C.reports(C.damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))).collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows_are_what_reports_digest(spark):
    df = C.damaged(spark.createDataFrame(random_turns(random.Random(6), 400), SCHEMA))
    by = {}
    for r in sorted(C.repaired(df).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.place)):
        by.setdefault(r.conv_id, []).append(r)
    reports = C.reports(df).collect()
    assert len(reports) == 41
    for r in reports:
        edits = by.get(r.conv_id, [])
        assert [e.place for e in edits] == list(range(len(edits)))
        assert "".join(e.edit for e in edits) == r.audit
        left = [e for e in edits if e.edit != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(e.role[:1] for e in left))
        assert hashlib.sha256("\n".join(f"{e.role}:{e.text}" for e in left).encode()).hexdigest() == r.repaired_sha256


@pytest.mark.parametrize("odd", [False, True])
def test_sql(spark, sf, odd):
    con = duckdb.connect()
    if odd:
        import pandas as pd

        rows = random_turns(random.Random(8), 600)
        df = spark.createDataFrame(rows, SCHEMA)
        frame = pd.DataFrame({"conv_id": pd.array([r[0] for r in rows], "Int64"), "turn": pd.array([r[1] for r in rows], "Int64"), "role": pd.array([r[2] for r in rows], "string"), "text": pd.array([r[3] for r in rows], "string")})
        con.register("conversations", frame)
    else:
        df = spark.read.parquet(f"{sf}/conversations.parquet")
        con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    got = C.reports(C.damaged(df))
    want = con.sql(C.SQL)
    assert got.columns == want.columns
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)

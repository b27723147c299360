import random

from textlake.llm import decontaminate as D
from textlake.llm.decontaminate import Matcher, leaks, masks_of, nearest, normal, pieces


def brute(item, text):
    """Least edits from item to any substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_against_table():
    rng = random.Random(1)
    for _ in range(500):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 30)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        for k in (0, 1, 3, 6):
            want = brute(item, text)
            assert nearest(item, masks_of(item), text, k) == (want if want <= k else k + 1)


def test_pieces_cover_item():
    for k in range(12):
        got = pieces("abcdefghijklmnopqrstuvwxyz" * 4, k)
        assert len(got) == k + 1 and "".join(p for _, p, _ in got) == "abcdefghijklmnopqrstuvwxyz" * 4


def test_finds_all_within_budget():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 25)))) for i in range(12)]
    m = Matcher(items, 0.1)
    for _ in range(150):
        _, item = rng.choice(items)
        s = list(item)
        for _ in range(rng.randint(0, int(0.13 * len(item)) + 1)):
            at, what = rng.randrange(len(s)), rng.random()
            s[at : at + 1] = [] if what < 0.3 else [rng.choice("abcxyz")] if what < 0.6 else [s[at], rng.choice("xyz")]
            s = s or ["a"]
        text = " ".join(word() for _ in range(rng.randint(0, 15))) + " " + "".join(s).upper() + ". " + word()
        want = {(i, brute(normal(t), normal(text)), len(t)) for i, t in items if brute(normal(t), normal(text)) <= int(0.1 * len(t))}
        assert set(m.find(text)) == want


def test_rows_and_blocks(spark):
    items = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (None, "x"), (3, "..."), (4, "seven eight nine ten eleven")], "item_id long, text string")
    docs = [(1, "He said: One, two, THREE four fve six!", 0), (1, "He said: One, two, THREE four fve six!", 0), (2, None, 1), (3, "", 2), (4, "seven eight nine ten elev", 3), (5, "word " * 30000 + "one two three four five six", 4), (6, "one two three", 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id long").withColumnRenamed("item_id", "distance_")
    for block in (8_000_000, 30):
        got = sorted((r.doc_id, r.item_id, r.distance) for r in leaks(df, items, ["doc_id"], block_bytes=block).collect())
        assert got == [(1, 1, 1), (1, 1, 1), (4, 4, 2), (5, 1, 0)]
    assert leaks(df.limit(0), items, ["doc_id"]).count() == 0
    assert leaks(df, items.limit(0), ["doc_id"]).count() == 0
    clash = leaks(df.withColumnRenamed("distance_", "item_id"), items, ["item_id", "doc_id"])
    assert clash.columns == ["item_id_", "doc_id", "item_id", "distance", "item_chars"] and clash.count() == 4


def test_short_items_need_whole_words(spark):
    items = [(1, "cat"), (2, "a b"), (3, "twelve is it")]
    found = lambda t: sorted(Matcher(items, 0.1).find(t))
    assert found("We concatenate cats; an a bee, a ba b's") == [] and found("a b's") == [(2, 0, 3)]
    assert found("Cat!") == [(1, 0, 3)] and found("(cat)") == [(1, 0, 3)]
    assert found("x twelve is itx") == [(3, 1, 12)] and found("xtwelve is itx") == []


def test_many_blocks_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 7)))
    items = [(i if i % 5 else None, " ".join(word() for _ in range(rng.randint(3, 20)))) for i in range(30)]
    docs = []
    for i in range(60):
        s = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, int(0.12 * len(s)))):
            s[rng.randrange(len(s))] = rng.choice("xyz ")
        docs.append((i, " ".join(word() for _ in range(rng.randint(0, 30))) + " " + "".join(s) + " " + word()))
    edits = {(d, k): brute(normal(t), normal(text)) for d, text in docs for k, (_, t) in enumerate(items)}
    hit = {(d, k) for (d, k), n in edits.items() if n <= int(0.1 * len(items[k][1]))}
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (100, 1 << 20):
        got = sorted((r.doc_id, r.item_id, r.distance) for r in leaks(df, it, ["doc_id"], block_bytes=block).collect())
        assert got == sorted((d, items[k][0], edits[d, k]) for d, k in hit if items[k][0] is not None)


def test_stage_of_many_blocks(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 7)))
    items = [" ".join(word() for _ in range(12)) for _ in range(9)]
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(i, word() + " " + (items[i % 9] if i % 3 == 0 else items[i % 9][:-4] + "zz" + items[i % 9][-3:] if i % 3 == 1 else word())) for i in range(45)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    want = [d for d, t in docs if all(brute(normal(x), normal(t)) > int(0.1 * len(x)) for x in items)]
    assert sorted(r.doc_id for r in D.stage(spark, df, str(tmp_path), block_bytes=120).collect()) == want and len(want) == 15


def test_stage_finds_items_without_id(spark, tmp_path):
    items = [(1, "one two three four five six"), (None, "seven eight nine ten eleven"), (None, None), (None, "...")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(1, "so: seven eight nine ten eleven."), (2, "one two three four five six"), (3, "neither"), (4, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in D.stage(spark, df, str(tmp_path)).collect()) == [3, 4]

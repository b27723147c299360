import random

import pytest
from pyspark.sql import functions as F

from textlake.operators import dedup
from textlake.sources import keyed_store as K

SCHEMA = "id string, seq long, a string, b long"
FIRST, LATEST = ["a"], ["b"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(store, number=None):
    return sorted((r.id or "", r.a, r.b) for r in store.read(number).collect())


def whole(spark, batches):
    """The full merge of all batches in order."""
    rows = [(*r, k) for k, batch in enumerate(batches) for r in batch]
    df = spark.createDataFrame(rows, f"{SCHEMA}, k long")
    return sorted((r.id or "", r.a, r.b) for r in dedup.merge(df, ["id"], [F.col("k"), F.col("seq")], FIRST, LATEST).collect())


def test_equals_the_full_merge_and_counts_batches_once(spark, tmp_path):
    rng, root = random.Random(3), f"file://{tmp_path}/t"
    store = K.KeyedStore(spark, root, ["id"], 4)
    with pytest.raises(ValueError, match="nothing"):
        store.read()
    batches = [[(rng.choice([None, *map(str, range(60))]), i, rng.choice([None, f"a{k}-{i}"]), rng.choice([None, i])) for i in range(40)] for k in range(4)]
    for k, batch in enumerate(batches):
        assert store.upsert(frame(spark, batch), [F.col("seq")], FIRST, LATEST, "job", k)["version"] == k
        assert table(store) == whole(spark, batches[: k + 1])
        assert store.upsert(frame(spark, batch[:3]), [F.col("seq")], FIRST, LATEST, "job", k) is None
    again = K.KeyedStore(spark, root, ["id"], 99)
    assert again.buckets == 4 and again.committed("job", 3) and not again.committed("job", 4) and not again.committed("other", 0)
    assert again.state()["ledger"] == {"job": [[0, 3]]}
    assert table(again, 1) == whole(spark, batches[:2])
    before = table(again)
    assert again.compact(0) == 4 and again.compact(1) == 0 and table(again) == before
    again.clean()
    assert table(again) == before


def test_only_files_with_a_key_are_rewritten(spark, tmp_path):
    store = K.KeyedStore(spark, f"file://{tmp_path}/t", ["id"], 32)
    base = spark.range(64_000).selectExpr("CAST(id AS STRING) AS id", "id AS seq", "'x' AS a", "id AS b")
    store.upsert(base, [F.col("seq")], FIRST, LATEST)
    one = store.upsert(frame(spark, [("17", 1, "new", -1)]), [F.col("seq")], FIRST, LATEST)
    assert one["own_rows"] == 1 and one["files_hit"] == 1 and one["rewritten_rows"] < 64_000 / 16 and one["table_rows"] == 64_000
    assert store.read().where("id = '17'").collect() == [("17", "x", -1)]
    new = store.upsert(frame(spark, [(f"n{i}", i, "n", i) for i in range(8)]), [F.col("seq")], FIRST, LATEST)
    assert new["rewritten_rows"] <= 8 * 4000 and new["files_hit"] < 8 and new["table_rows"] == 64_008
    assert store.read().count() == store.read().select("id").distinct().count() == 64_008


@pytest.mark.parametrize("where", ["own", "merged", "before commit", "after commit"])
def test_a_failure_leaves_all_or_nothing(spark, tmp_path, monkeypatch, where):
    store = K.KeyedStore(spark, f"file://{tmp_path}/t", ["id"], 2)
    store.upsert(frame(spark, [("a", 0, "1", 1), ("b", 0, "1", 1)]), [F.col("seq")], FIRST, LATEST, "job", 0)
    before, change = table(store), frame(spark, [("a", 1, "2", 2), ("c", 1, "2", 2)])
    write, add, calls = store._write, store.log.add, []

    def failing_write(rows, name):
        calls.append(name)
        out = write(rows, name)
        if len(calls) == (1 if where == "own" else 2):
            raise OSError("injected")
        return out

    def failing_add(number, commit):
        if where == "after commit":
            add(number, commit)
        raise OSError("injected")

    with monkeypatch.context() as m:
        if where in ("own", "merged"):
            m.setattr(store, "_write", failing_write)
        else:
            m.setattr(store.log, "add", failing_add)
        with pytest.raises(OSError, match="injected"):
            store.upsert(change, [F.col("seq")], FIRST, LATEST, "job", 1)
    done = where == "after commit"
    assert store.committed("job", 1) == done
    after = [("a", "1", 2), ("b", "1", 1), ("c", "2", 2)]
    assert table(store) == (after if done else before)
    assert (store.upsert(change, [F.col("seq")], FIRST, LATEST, "job", 1) is None) == done
    assert table(store) == after
    store.clean()
    assert table(store) == after


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/t"
    one, two = (K.KeyedStore(spark, root, ["id"], 2) for _ in range(2))
    one.upsert(frame(spark, [("a", 0, "1", 1)]), [F.col("seq")], FIRST, LATEST, "one", 0)
    add = one.log.add

    def late_add(number, commit):
        monkeypatch.setattr(one.log, "add", add)
        two.upsert(frame(spark, [("a", 0, "2", 2), ("d", 0, "2", 2)]), [F.col("seq")], FIRST, LATEST, "two", 0)
        return add(number, commit)

    monkeypatch.setattr(one.log, "add", late_add)
    made = one.upsert(frame(spark, [("a", 0, "3", 3), ("e", 0, "3", 3)]), [F.col("seq")], FIRST, LATEST, "one", 1)
    assert made["version"] == 2
    assert table(one) == [("a", "1", 3), ("d", "2", 2), ("e", "3", 3)]
    assert two.state()["ledger"] == {"one": [[0, 1]], "two": [[0, 0]]}


def test_batch_numbers_as_ranges():
    ranges, rng = [], random.Random(1)
    numbers = rng.sample(range(100), 60)
    for n in numbers:
        ranges = K.with_number(ranges, n)
    assert all(K.within(ranges, n) == (n in numbers) for n in range(100))
    assert all(b[0] > a[1] + 1 for a, b in zip(ranges, ranges[1:]))

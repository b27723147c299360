import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlake.operators import dedup, intervals, logs, scans


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 9 + ["a", "b", None]), rng.choice([None, *range(3000)]), i, rng.choice([None, *range(100)])) for i in range(6000)]
    return spark.createDataFrame(rows, "k string, o long, i long, v long").repartition(6).cache()


@pytest.mark.parametrize("least_rows", [10, 1_000_000])
def test_equals_plain_windows(skewed, least_rows):
    w = Window.partitionBy("k").orderBy("o", "i")
    want = skewed.withColumns({"p": F.lag("v").over(w), "q": F.lag("i").over(w), "m": F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1))})
    got = scans.with_previous(skewed, ["k"], ["o", "i"], {"p": F.col("v"), "q": F.col("i")}, {"m": F.col("v")}, least_rows)
    cols = ("k", "o", "i", "v", "p", "q", "m")
    assert rows_of(got, *cols) == rows_of(want, *cols)


def test_one_key_with_all_rows_uses_all_tasks(spark):
    df = spark.range(40_000).selectExpr("'one' AS k", "id AS o", "id % 7 AS v")
    cut, several = scans.blocked(df, ["k"], "o", 1000)
    sizes = [r.n for r in cut.groupBy(scans.BLOCK).agg(F.count("*").alias("n")).collect()]
    assert several and len(sizes) >= 2 * 4 and max(sizes) < 40_000 / 4
    out = scans.with_previous(df, ["k"], ["o"], {"p": F.col("o")}, least_rows=1000)
    assert out.where("p <=> o - 1").count() == 39_999 and out.where("p IS NULL").count() == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"hashpartitioning\([^)]*{scans.BLOCK}", plan) and "BroadcastHashJoin" in plan


def test_the_order_may_tie_or_be_text(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2)] * 300, "k string, o string, i long")
    got = scans.with_previous(df, ["k"], ["o", "i"], {"p": F.col("i")}, least_rows=10)
    assert got.where("p IS NULL").count() == 1
    tied = spark.createDataFrame([("k", 5, i) for i in range(500)], "k string, o long, i long")
    got = scans.with_previous(tied, ["k"], ["o", "i"], {"p": F.col("i")}, least_rows=10)
    assert got.where("p = i - 1").count() == 499
    assert scans.with_previous(tied.limit(0), ["k"], ["o"], {"p": F.col("i")}, least_rows=0).count() == 0


def test_operators_with_all_rows_in_one_key(spark):
    rng = random.Random(5)
    times = sorted(rng.sample(range(100_000), 4000))
    w = spark.createDataFrame([("s", t, t + rng.randint(1, 60)) for t in times], "source string, a long, b long").selectExpr("source", "timestamp_seconds(a) AS window_start", "timestamp_seconds(b) AS window_end")
    for f in (lambda n: intervals.gaps(w, ["source"], least_rows=n), lambda n: logs.replay_delays(w, ["source"], "window_start", "window_end", 2.0, 9.0, n)):
        assert rows_of(f(100), "*") == rows_of(f(10**9), "*")
    steps = spark.createDataFrame([("r", i // 2 if i % 50 == 0 else i + i // 900, i + (i % 31 == 0)) for i in range(4000)], "run string, seq long, t long")
    a, b = (logs.sequence_faults(steps, "run", "seq", "t", n) for n in (100, 10**9))
    assert rows_of(a, "*") == rows_of(b, "*") and a.count() > 50


def test_duplicates_without_a_window(skewed):
    order = [F.col("o"), F.col("i")]
    got = dedup.duplicates(skewed, ["k"], order)
    first = dedup.first_wins(skewed, ["k"], order)
    assert rows_of(got.unionByName(first), "*") == rows_of(skewed, "*") and first.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan

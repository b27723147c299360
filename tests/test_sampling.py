import hashlib
import random

from pyspark.sql import functions as F

from textlake.operators import sampling


def lowest(rows, k, seed="sample"):
    """Rows of lowest hash by group, from the definition."""
    by = {}
    for g, i in rows:
        by.setdefault(g, []).append((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), g, i))
    return sorted(((g, i) for x in by.values() for _, g, i in sorted(x)[: k(x[0][1])]), key=repr)


def test_the_lowest_hashes_of_each_group_in_any_partitioning(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 20 + ["a", "b", None]), i) for i in range(8000)] + [("one", 9000)]
    df = spark.createDataFrame(rows, "g string, i long")
    for k in (1, 7, 300, 10_000):
        got = [sorted((tuple(r) for r in sampling.per_group(df.repartition(n), ["g"], "i", k).collect()), key=repr) for n in (1, 9)]
        assert got[0] == got[1] == lowest(rows, lambda g, k=k: k)
    own = F.when(F.col("g") == "hot", 50).when(F.col("g") == "a", 0).otherwise(3)
    got = sorted((tuple(r) for r in sampling.per_group(df, ["g"], "i", own, "s").collect()), key=repr)
    assert got == lowest(rows, lambda g: {"hot": 50, "a": 0}.get(g, 3) if g else 3, "s")
    assert sampling.per_group(df.limit(0), ["g"], "i", 5).count() == 0
    assert sampling.per_group(df, [], "i", 4).count() == 4


def test_no_window_and_few_rows_gathered(spark):
    df = spark.range(200_000).selectExpr("id AS i", "'one' AS g", "repeat('x', 20) AS t")
    out = sampling.per_group(df, ["g"], "i", 100)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    h = df.withColumn("_h", sampling.hash_order(F.col("i"), "sample"))
    worst = out.join(h, "i").agg(F.max("_h")).first()[0]
    assert out.count() == 100 and h.where(F.col("_h") <= worst).count() == 100


def test_uniform(spark):
    """Each of 40 rows is in a sample of 10 about as often as any other, over 400 seeds."""
    rows = [i for i in range(40)]
    times = [0] * 40
    for seed in range(400):
        order = sorted(rows, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
        for i in order[:10]:
            times[i] += 1
    chi = sum((t - 100) ** 2 / 100 for t in times)
    assert chi < 75  # 39 degrees of freedom, less than one in a thousand
    df = spark.createDataFrame([("g", i) for i in rows], "g string, i long")
    for seed in ("0", "1", "399"):
        assert sorted(r.i for r in sampling.per_group(df, ["g"], "i", 10, seed).collect()) == sorted(sorted(rows, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())[:10])

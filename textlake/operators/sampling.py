"""Samples without a random generator: the rows whose ids hash lowest, so any run and any partitioning agrees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scans import same


def hash_order(ident: Column, seed: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(seed), ident.cast("string")), 256)


#: Steps of a hash's place on a logarithmic scale, for each halving; at most 1,024 steps in all.
STEPS = 16


def per_group(df: DataFrame, keys: Sequence[str], ident: str, k: Column | int, seed: str = "sample") -> DataFrame:
    """At most ``k`` rows of each group, those of lowest hash; ``k`` may be a column that is the same in a group.

    A reservoir that partial aggregates merge: rows are counted by group and step of their hash, a few
    hundred numbers a group and task, and the step at which ``k`` is reached tells which rows can be
    among the lowest. Only these, hardly more than ``k``, are gathered; no group is sorted or moved as a
    whole. Rows of one ``ident`` have one hash, so idents should be unique in a group. Null keys are a key.
    """
    h = df.withColumns({"_h": hash_order(F.col(ident), seed), "_k": F.lit(k).cast("long") if isinstance(k, int) else k.cast("long")})
    # 52 bits of the hash as a fraction; low hashes have high steps
    low = (F.conv(F.left("_h", F.lit(13)), 16, 10).cast("double") + 1) / float(16**13)
    h = h.withColumn("_step", F.least(F.floor(-F.log2(low) * STEPS), F.lit(64 * STEPS)).cast("int"))
    names = {c: f"_k{i}" for i, c in enumerate(keys)}
    group = [F.col(c).alias(n) for c, n in names.items()]
    counts = h.groupBy(*group, "_step").agg(F.count("*").alias("n"), F.max("_k").alias("_most"))
    steps = F.reverse(F.array_sort(F.collect_list(F.struct("_step", "n"))))
    reach = F.aggregate(
        "_steps",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).alias("cut")),
        lambda a, s: F.struct((a["seen"] + s["n"]).alias("seen"), F.when(a["seen"] < F.col("_most"), s["_step"]).otherwise(a["cut"]).alias("cut")),
    )
    cuts = counts.groupBy(*names.values()).agg(steps.alias("_steps"), F.max("_most").alias("_most")).where("_most > 0").select(*names.values(), reach["cut"].alias("_cut"))
    near = h.join(cuts, same(h, cuts, names)).where(F.col("_step") >= F.col("_cut"))
    rows = F.array_sort(F.collect_list(F.struct("_h", ident, F.struct(*df.columns).alias("_row"))), lambda x, y: F.when(x["_h"] < y["_h"], -1).when(x["_h"] > y["_h"], 1).otherwise(0))
    kept = near.groupBy(*group).agg(rows.alias("_rows"), F.max("_k").alias("_most"))
    return kept.select(F.explode(F.slice("_rows", F.lit(1), F.least(F.col("_most"), F.size("_rows")).cast("int"))).alias("_one")).select("_one._row.*")


def first_eligible(df: DataFrame, keep: Column, keys: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows (0: all) by ``order`` among first occurrences of ``keys`` that ``keep`` holds for."""
    from .dedup import first_wins

    rows = first_wins(df.where(keep), keys, order)
    return rows.orderBy(*order).limit(limit) if limit else rows

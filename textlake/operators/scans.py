"""Scans in order over keys of which one may have most rows.

What a row needs of those before it (the row before, a running maximum) comes from a window, and a
window has a key's rows in one task. Here the rows of a key that has far more than its share are cut
into blocks along the order; windows see a block, and what each block has to know of those before it
comes from one summary row a block. Keys with few rows stay whole, so their windows are as ever.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

#: Quantiles that are estimated of the order of a key with many rows; no key has more blocks.
QUANTILES = 256
BLOCK = "_block"


def same(left: DataFrame, right: DataFrame, names: Mapping[str, str]) -> Column:
    """Columns of ``left`` and what they are called in ``right`` are equal, nulls too."""
    return functools.reduce(Column.__and__, [left[a].eqNullSafe(right[b]) for a, b in names.items()], F.lit(True))


def blocked(df: DataFrame, keys: Sequence[str], order: str, least_rows: int) -> tuple[DataFrame, bool]:
    """``df`` with _block, which follows ``order`` (a number, date or time; nulls first), and whether any key has several.

    A key has several blocks if it has over ``least_rows`` rows and over a task's share; there are
    fewer such keys than shuffle partitions, and their borders, a few for each partition, are the
    only thing that comes to the driver.
    """
    spark, kind = df.sparkSession, df.schema[order].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType)):
        return df.withColumn(BLOCK, F.lit(0)), False
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = df.count()
    many = counts.where(F.col("_n") > max(least_rows, total // max(tasks, 1)))
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    many = many.select(*[F.col(k).alias(n) for k, n in names.items()], "_n").collect() if total > least_rows else []
    if not many:
        return df.withColumn(BLOCK, F.lit(0)), False
    hot = spark.createDataFrame(many, T.StructType([T.StructField(n, df.schema[k].dataType) for k, n in names.items()] + [T.StructField("_n", T.LongType())]))
    of_hot = df.select(*keys, order).join(F.broadcast(hot), same(df, hot, names))
    marks = F.percentile_approx(order, [i / QUANTILES for i in range(1, QUANTILES)], 10 * QUANTILES)
    # twice as many blocks as tasks have shares, spread over the quantiles
    wanted = F.least(F.lit(QUANTILES), F.ceil(F.lit(2 * tasks) * F.col("_n") / F.lit(total)) + 1).cast("int")
    chosen = F.array_distinct(F.transform(F.sequence(F.lit(1), wanted - 1), lambda i: F.get("_marks", F.floor(i * QUANTILES / wanted).cast("int") - 1)))
    borders = of_hot.groupBy(*names.values(), "_n").agg(marks.alias("_marks")).select(*names.values(), chosen.alias("_borders"))
    borders = spark.createDataFrame(borders.collect(), borders.schema)  # once, so that all that follows has the same blocks
    place = F.when(F.col(order).isNull() | F.col("_borders").isNull(), 0).otherwise(F.size(F.filter("_borders", lambda b: b < F.col(order))))
    return df.join(F.broadcast(borders), same(df, borders, names), "left").withColumn(BLOCK, place).select(*df.columns, BLOCK), True


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: Mapping[str, Column] = {}, most: Mapping[str, Column] = {}, least_rows: int = 100_000) -> DataFrame:
    """``df`` with values of ``last`` in the row before, and maxima of ``most`` over all rows before, of the same ``keys`` by ``order``.

    The first row of a key has nulls. ``order`` should be total; rows that tie in all of it are in any
    order. Rows of one key that tie in its first column stay in one block.
    """
    rows, cut = blocked(df, keys, order[0], least_rows)
    w = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumns({n: F.lag(c).over(w) for n, c in last.items()} | {n: F.max(c).over(before) for n, c in most.items()} | {"_first": F.row_number().over(w) == 1})
    if not cut:
        return out.drop(BLOCK, "_first")
    end = F.max_by(F.struct(*[c.alias(n) for n, c in last.items()], F.lit(True).alias("_some")), F.struct(*order))
    sums = rows.groupBy(*keys, BLOCK).agg(end.alias("_last"), *[F.max(c).alias(n) for n, c in most.items()])
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    carried = sums.withColumns({"_last": F.lag("_last").over(along)} | {n: F.max(n).over(along.rowsBetween(Window.unboundedPreceding, -1)) for n in most})
    names = {k: f"_k{i}" for i, k in enumerate([*keys, BLOCK])}
    carried = carried.where(f"{BLOCK} > 0").select(*[F.col(k).alias(n) for k, n in names.items()], "_last", *[F.col(n).alias(f"_most_{n}") for n in most])
    # blocks after a key's first: at most two for each shuffle partition and QUANTILES
    both = out.join(F.broadcast(carried), same(out, carried, names), "left")
    both = both.withColumns({n: F.when(F.col("_first"), F.col(f"_last.{n}")).otherwise(F.col(n)) for n in last} | {n: F.greatest(n, f"_most_{n}") for n in most})
    return both.select(*df.columns, *last, *most)

"""Manifests against results, and usage against what a batch reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .dedup import first_wins

TERMINAL = ("completed", "failed", "expired", "cancelled")


def request_states(manifest: DataFrame, results: DataFrame, batch_status: str) -> DataFrame:
    """``manifest`` with status, validation_result and error_code of each request; ``results`` has a row a custom_id."""
    r = results.select("custom_id", F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    joined = manifest.join(r, "custom_id", "left")
    return joined.withColumns(
        {
            "status": F.when(hit, "completed").otherwise("failed" if batch_status in TERMINAL else "submitted"),
            "validation_result": F.when(hit, "validated").otherwise("missing_result"),
            "error_code": F.when(~hit, "MISSING_RESULT"),
        }
    ).drop("_hit")


def missing_results(manifest: DataFrame, results: DataFrame) -> DataFrame:
    return manifest.join(results.select("custom_id"), "custom_id", "left_anti")


def unknown_results(manifest: DataFrame, results: DataFrame) -> DataFrame:
    return results.join(manifest.select("custom_id"), "custom_id", "left_anti")


def accepted_results(manifest: DataFrame, results: DataFrame, order: list) -> tuple[DataFrame, DataFrame]:
    """First result of each known request, and the count of each outcome: accepted, repeated, unknown, missing."""
    first = first_wins(results, ["custom_id"], order)
    known = first.join(manifest.select("custom_id"), "custom_id", "left_semi")
    per = results.groupBy("custom_id").agg(F.count("*").alias("n")).join(manifest.select("custom_id", F.lit(1).alias("m")), "custom_id", "full")
    counts = per.agg(
        F.count_if(F.col("n").isNotNull() & F.col("m").isNotNull()).alias("accepted"),
        F.coalesce(F.sum(F.when(F.col("m").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("repeated"),
        F.coalesce(F.sum(F.when(F.col("m").isNull(), F.col("n"))), F.lit(0)).alias("unknown"),
        F.count_if(F.col("n").isNull()).alias("missing"),
    )
    return known, counts


def reconcile_usage(generations: DataFrame, batches: DataFrame) -> DataFrame:
    """A row a batch: summed usage of its generations, and not_available, mismatched or matched.

    ``generations`` has batch_id and nullable input_tokens and output_tokens; ``batches`` has batch_id,
    the two as reported (nullable) and expected_count.
    """
    summed = generations.groupBy("batch_id").agg(
        F.count("*").alias("generation_count"),
        F.count("input_tokens").alias("available"),
        F.sum("input_tokens").alias("sum_input"),
        F.sum("output_tokens").alias("sum_output"),
    )
    j = batches.join(summed, "batch_id", "left").withColumns({"generation_count": F.coalesce("generation_count", F.lit(0)), "available": F.coalesce("available", F.lit(0))})
    same = (F.col("available") == F.col("expected_count")) & (F.col("sum_input") == F.col("input_tokens")) & (F.col("sum_output") == F.col("output_tokens"))
    return j.withColumn("reconciliation", F.when(F.col("input_tokens").isNull() | (F.col("available") == 0), "not_available").when(same, "matched").otherwise("mismatched"))


def day_results(manifests: DataFrame, results: DataFrame) -> DataFrame:
    """``results`` with the day of the manifest that asked for each; reading it fails if either side has a custom_id that the other lacks."""
    asked, got = manifests.select("custom_id", "day", F.lit(True).alias("_asked")), results.withColumn("_got", F.lit(True))
    both = asked.join(got, "custom_id", "full")
    whole = F.assert_true(F.col("_asked").isNotNull(), F.concat(F.lit("result without a manifest: "), F.col("custom_id"))).isNull()
    whole &= F.assert_true(F.col("_got").isNotNull(), F.concat(F.lit("no result for "), F.col("custom_id"))).isNull()
    return both.where(whole).drop("_asked", "_got")


#: Sums of the daily report.
DAILY_SUMS = ("failed_rows", "input_tokens", "output_tokens", "cached_input_tokens", "reasoning_output_tokens")


def daily_report(daily: DataFrame, first: str, last: str) -> DataFrame:
    """One row over ``daily`` (day, status, validated_rows, cost_usd and DAILY_SUMS) of the days from ``first`` to ``last``.

    Nulls count as 0; days without a row are pending, like those that aren't completed.
    """
    rows = daily.where(F.col("day").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    done, days = F.col("status") == "completed", F.datediff(F.to_date(F.lit(last)), F.to_date(F.lit(first))) + 1
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    sums = rows.agg(F.count_if(done).alias("completed_days"), total("validated_rows"), *map(total, DAILY_SUMS), total("cost_usd"))
    return sums.select(days.alias("requested_days"), (days - F.col("completed_days")).alias("pending_days"), "*")


def batch_context(manifest: DataFrame, labels: dict[str, str]) -> DataFrame:
    """By llm_batch_id: its periods from least to largest, blank ones left out, and its groups' labels in the order of their names.

    ``labels`` is configuration; a group without a label is called by its name.
    """
    period = F.nullif(F.trim("period"), F.lit(""))
    named = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]) if labels else F.create_map(F.lit(""), F.lit(""))
    per = manifest.groupBy("llm_batch_id").agg(F.min(period).alias("a"), F.max(period).alias("z"), F.array_sort(F.collect_set("group_name")).alias("g"))
    span = F.when(F.col("a") == F.col("z"), F.col("a")).otherwise(F.concat("a", F.lit(" ~ "), "z"))
    return per.select("llm_batch_id", span.alias("period"), F.array_join(F.transform("g", lambda x: F.coalesce(F.try_element_at(named, x), x)), ", ").alias("groups"))


def offset_span(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """By topic: messages between the offsets of ``starts`` and ``ends`` (topic, partition, offset).

    Reading it fails if one side has a partition that the other lacks, or an end is before its start.
    """
    a, z = starts.withColumnRenamed("offset", "a"), ends.withColumnRenamed("offset", "z")
    both = a.join(z, ["topic", "partition"], "full")
    told = lambda what: F.concat(F.lit(what), F.col("topic"), F.lit("["), F.col("partition").cast("string"), F.lit("]"))
    ok = F.assert_true(F.col("a").isNotNull() & F.col("z").isNotNull(), told("partitions differ: ")).isNull() & F.assert_true(F.col("z") >= F.col("a"), told("the end is before the start: ")).isNull()
    return both.where(ok).groupBy("topic").agg(F.sum(F.col("z") - F.col("a")).alias("span"))

"""The text quality policy, version 1, as expressions over the whole text."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from . import kernels

# Fixed values of the policy.
POLICY_VERSION = 1
SOFT_CHARACTERS = 5_000
HARD_CHARACTERS = 20_000
HARD_BYTES = 65_536
COMBINING_RUN = 8
REPETITION_CHARACTERS = 100
REPETITION_RATIO = 0.80
URL_COUNT = 2
URL_RATIO = 0.50
ZERO_WIDTH = "​⁠﻿"
TOMBSTONES = ("[deleted]", "[removed]")
FLAGS = ("SOURCE_TOMBSTONE", "EMPTY_AFTER_NORMALIZATION", "EXCESSIVE_LENGTH", "EXCESSIVE_UTF8_BYTES", "CONTROL_CHARACTERS", "ZERO_WIDTH_CHARACTERS", "EXCESSIVE_COMBINING_MARKS", "HIGH_REPETITION", "URL_HEAVY", "POSSIBLE_PII")

CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
WHITE = r"[\s\x1c-\x1f\x85\p{Z}]"
# Patterns of the policy, fixed values too.
MARK = r"[\p{M}\p{Cn}]"
URL = r"(?iU)(?:https?://|www\.)[^\s]+"
EMAIL = r"(?iU)(?<![\w.+-])[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}(?![\w.-])"
PHONE = r"(?U)(?<!\d)(?:\+?\d[\d ()-]{7,}\d)(?!\d)"


@functools.lru_cache(maxsize=1)
def combining_class() -> str:
    """A regex class of all characters with a canonical combining class, made from the Unicode data."""
    points = [c for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))]
    ranges, start = [], points[0]
    for a, b in zip(points, points[1:] + [None]):
        if b != a + 1:
            ranges.append(f"\\x{{{start:x}}}-\\x{{{a:x}}}")
            start = b
    return f"[{''.join(ranges)}]"


@functools.lru_cache(maxsize=1)
def white_characters() -> str:
    """All characters of WHITE."""
    zs = (chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "Z")
    return "".join(dict.fromkeys(("\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85", *zs)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(white_characters()))


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def personal(text: Column) -> Column:
    """Whether the text holds an address or a telephone number; both patterns only run where they can match."""
    return (text.contains("@") & text.rlike(EMAIL)) | (text.rlike(r"(?U)\d") & text.rlike(PHONE))


def urls_in(text: Column) -> Column:
    """All URLs; without ``://`` or two w's there are none, so most texts need only byte searches."""
    can = functools.reduce(Column.__or__, [text.contains(x) for x in ("://", "ww", "wW", "Ww", "WW")])
    return F.when(can, matches(text, URL)).when(text.isNotNull(), F.array().cast("array<string>"))


def marks_in(text: Column) -> Column:
    """All runs of characters that combine; null for most texts that have none.

    Such a character is a mark, or one that the JVM doesn't know yet. That is a look-up in a table, while
    the class has hundreds of ranges, which are only tried on these characters.
    """
    return F.when(text.rlike(MARK), matches(text, f"[{MARK}&&{combining_class()}]+"))


def add_quality(events: DataFrame, text: str = "text", when: str | None = None) -> DataFrame:
    """``events`` with the policy's 15 columns; all are null where ``when`` is false or the text null.

    Length and bytes are of the text as it came, combining marks, URLs, repetition and personal data
    of text_clean. Ratios have four places. One regex pass each, behind a cheap test where there is
    one; only NFC of texts that aren't ASCII and the repetition figures of texts of 100 characters
    leave the JVM, in Arrow batches.
    """
    t = F.when(F.col(when), F.col(text)) if when else F.col(text)
    df = events.withColumn("_q", t)
    q, odd = F.col("_q"), F.col("_odd")
    # each step that several others read is a column of its own, so no pattern runs twice
    df = df.withColumn("_odd", functools.reduce(Column.__or__, [q.contains(x) for x in ZERO_WIDTH]) | q.rlike(CONTROL))
    df = df.withColumn("_nfc", kernels.nfc(F.when(odd, F.regexp_replace(q, f"{CONTROL}|[{ZERO_WIDTH}]", "")).otherwise(q)))
    df = df.withColumn("text_clean", strip(F.col("_nfc")))
    clean, compact, urls = F.col("text_clean"), F.col("_compact"), F.col("_urls")
    df = df.withColumns({"_compact": F.regexp_replace(clean, WHITE + "+", ""), "_urls": urls_in(clean)})
    df = df.withColumn("_r", kernels.repetition(F.when(F.length(compact) >= REPETITION_CHARACTERS, compact)))
    covered = F.aggregate(urls, F.lit(0), lambda a, u: a + F.length(u))
    marks = marks_in(clean)
    four = lambda x: F.round(x, 4)
    some = lambda c: F.when(q.isNotNull(), c)
    df = df.withColumns(
        {
            "quality_policy_version": some(F.lit(POLICY_VERSION)),
            "character_count": F.length(q).cast("long"),
            "utf8_byte_count": F.octet_length(q).cast("long"),
            "control_character_count": F.when(odd, F.regexp_count(q, F.lit(CONTROL))).when(~odd, 0).cast("long"),
            "zero_width_count": F.when(odd, F.regexp_count(q, F.lit(f"[{ZERO_WIDTH}]"))).when(~odd, 0).cast("long"),
            "max_combining_mark_run": F.coalesce(F.array_max(F.transform(marks, lambda m: F.length(m))), some(F.lit(0))),
            "url_count": some(F.size(urls)),
            "url_ratio": some(F.when(clean == "", 0.0).otherwise(four(covered / F.length(clean)))),
            "repetition_ratio": some(four(F.greatest("_r.dominant", "_r.savings", F.lit(0.0)))),
            "was_normalized": clean != q,
            "was_truncated": some(F.lit(False)),
        }
    )
    long, heavy = F.col("character_count") > SOFT_CHARACTERS, F.col("utf8_byte_count") > HARD_BYTES
    tests = (
        (F.length(clean) <= max(map(len, TOMBSTONES))) & F.lower(strip(q)).isin(*TOMBSTONES),
        clean == "",
        long,
        heavy,
        F.col("control_character_count") > 0,
        F.col("zero_width_count") > 0,
        F.col("max_combining_mark_run") > COMBINING_RUN,
        F.col("repetition_ratio") >= REPETITION_RATIO,
        (F.col("url_count") >= URL_COUNT) & (F.col("url_ratio") >= URL_RATIO),
        personal(clean),
    )
    df = df.withColumn("quality_flags", some(F.array_compact(F.array(*[F.when(c, F.lit(f)) for f, c in zip(FLAGS, tests)]))))
    has = lambda f: F.array_contains("quality_flags", f)
    reason = F.when(has("SOURCE_TOMBSTONE"), "SOURCE_TOMBSTONE").when(has("EMPTY_AFTER_NORMALIZATION"), "EMPTY_AFTER_NORMALIZATION")
    reason = reason.when(F.col("character_count") > HARD_CHARACTERS, "EXCESSIVE_LENGTH")
    for f in ("EXCESSIVE_UTF8_BYTES", "EXCESSIVE_COMBINING_MARKS", "POSSIBLE_PII"):
        reason = reason.when(has(f), f)
    df = df.withColumn("exclusion_reason", reason)
    rejected = F.col("exclusion_reason").isin("SOURCE_TOMBSTONE", "EMPTY_AFTER_NORMALIZATION")
    status = F.when(rejected, "reject").when(F.col("exclusion_reason").isNotNull(), "quarantine").when(F.size("quality_flags") > 0, "flag").otherwise("accept")
    return df.withColumn("quality_status", some(status)).drop("_q", "_odd", "_nfc", "_compact", "_urls", "_r")

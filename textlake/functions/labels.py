"""The label gate, version 1: topics and keywords are normalized, tested and made distinct."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from . import kernels

# Fixed values of the gate.
SMART, PLAIN = "‘’–— ", "''-- "
META = r"(?i)\b(?:keep short|return only|requested json|do not infer|system prompt)\b"
LONG_RUN = "[A-Za-z0-9]{24,}"
ALLOWED = r"\A[A-Za-z0-9][A-Za-z0-9 &'()+,./:-]*\z"
WORD = "[A-Za-z0-9]+(?:'[A-Za-z0-9]+)?"
MOST_WORDS = {"topics": 8, "keywords": 6}
#: Joins an array's labels for one pass through the Unicode kernel.
UNIT = "\x1f"


def collapse(text: Column) -> Column:
    """Smart punctuation made plain, control and format characters dropped, blanks single. NFKC comes before."""
    plain = F.regexp_replace(F.translate(text, SMART, PLAIN), r"\p{C}", "")
    return F.trim(F.regexp_replace(plain, r"[\s\p{Z}]+", " "))


def compatible(labels: Column) -> Column:
    """The labels in NFKC; null ones, which the kernel's joined text can't hold, as empty ones."""
    return F.split(kernels.nfkc(F.array_join(F.transform(labels, lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), UNIT, "")), UNIT)), UNIT)


def verdicts(labels: Column, collapsed: Column, field: str) -> Column:
    """For each label struct(value, clean, reason, changed); clean is null where reason says why it goes.

    ``collapsed`` has the collapsed labels, a column of its own, so that none is made for each test.
    """

    def judge(value: Column, i: Column) -> Column:
        c = F.get(collapsed, i)
        reason = (
            F.when(c == "", "empty_after_normalization")
            .when(c.rlike(r"[^\x00-\x7f]"), "non_ascii_character")
            .when(~c.rlike(ALLOWED), "disallowed_character")
            .when(c.rlike(META), "prompt_meta_phrase")
            .when(c.rlike(LONG_RUN), "suspicious_alphanumeric_run")
            .when(F.regexp_count(c, F.lit(WORD)) > MOST_WORDS[field], "too_many_words")
        )
        return F.struct(value.alias("value"), F.when(reason.isNull(), c).alias("clean"), reason.alias("reason"), (c != value).alias("changed"))

    return F.transform(labels, judge)


def gate(df: DataFrame, fields: tuple[str, ...] = ("topics", "keywords")) -> DataFrame:
    """``df`` with its label arrays cleaned, and removed_labels, gate_reasons (one entry a label and reason) and gate_status.

    Labels equal without regard to case are one, the first stays. Null arrays count as empty ones.
    """
    old = {f: F.coalesce(F.col(f), F.array().cast("array<string>")) for f in fields}
    step = lambda name, of: df.withColumns({f"_{f}{name}": of(f) for f in fields})
    # a step of all fields at a time: one pass through the kernel, and nothing made twice
    df = step("_normal", lambda f: compatible(old[f]))
    df = step("_flat", lambda f: F.transform(f"_{f}_normal", collapse))
    df = step("", lambda f: verdicts(old[f], F.col(f"_{f}_flat"), f))
    df = step("_kept", lambda f: F.array_compact(F.transform(f"_{f}", lambda v: v["clean"])))
    df = step("_names", lambda f: F.transform(f"_{f}_kept", lambda x: F.lower(x)))
    df = step("_first", lambda f: F.filter(f"_{f}_kept", lambda x, i: F.array_position(F.col(f"_{f}_names"), F.lower(x)) == i + 1))
    removed = sum((F.size(f"_{f}") - F.size(f"_{f}_first") for f in fields), F.lit(0))
    modified = functools.reduce(Column.__or__, [~old[f].eqNullSafe(F.col(f"_{f}_first")) for f in fields])
    reasons = []
    for f in fields:
        reasons += [
            F.transform(F.filter(f"_{f}", lambda v: v["changed"]), lambda v: F.lit("unicode_or_whitespace_normalized")),
            F.transform(F.filter(f"_{f}", lambda v: v["reason"].isNotNull()), lambda v: v["reason"]),
            F.array_repeat(F.lit("duplicate_after_normalization"), F.size(f"_{f}_kept") - F.size(f"_{f}_first")),
        ]
    df = df.withColumns({"removed_labels": removed, "gate_reasons": F.concat(*reasons), "gate_status": F.when(modified, "modified").otherwise("passed")})
    df = df.withColumns({f: F.col(f"_{f}_first") for f in fields})
    return df.drop(*[f"_{f}{x}" for f in fields for x in ("", "_normal", "_flat", "_kept", "_names", "_first")])

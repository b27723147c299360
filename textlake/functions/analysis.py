"""Analysis results: schema checks, derived sentiment, tone shares, semantic checks, versions, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import json_schema

# Fixed values of the analysis contract.
POSITIVE_TONES = ("optimism", "hope", "satisfaction", "trust", "enthusiasm", "gratitude", "relief")
NEGATIVE_TONES = ("anger", "anxiety", "frustration", "distrust", "sadness", "cynicism", "disappointment")
MOST_TONE_TOTAL = 1.25
TOLERANCE = 0.01
SENTIMENTS = ("positive", "neutral", "negative")
POLARIZATIONS = ("low", "medium", "high")
#: Most items and most characters of an item of the lists of texts; most characters of the summary; most tones and drivers.
LISTS = {"topics": (5, 80), "keywords": (8, 60)}
SUMMARY, TONES, DRIVERS = 400, 4, (4, 80)
FIELDS_V3 = ("estimated_sentiment_distribution", "polarization", "polarization_score", "topics", "keywords", "summary", "positive_tones", "negative_tones")


def total(tones: Column) -> Column:
    return F.aggregate(tones, F.lit(0.0), lambda a, t: a + t["share"])


def derive_sentiment(df: DataFrame, distribution: str = "estimated_sentiment_distribution") -> DataFrame:
    """``df`` with dominant_sentiment and sentiment_score from the distribution.

    Equal positive and negative shares are neutral with score 0; else the largest share decides, the
    first of positive, neutral, negative among equals. A null distribution gives nulls.
    """
    p, u, n = (F.col(f"{distribution}.{k}") for k in ("positive", "neutral", "negative"))
    dominant = F.when(p == n, "neutral").when((p >= u) & (p >= n), "positive").when(u >= n, "neutral").when(n.isNotNull(), "negative")
    return df.withColumns({"dominant_sentiment": dominant, "sentiment_score": F.round(p - n, 6)})


def correct_dominant(df: DataFrame, distribution: str = "estimated_sentiment_distribution") -> DataFrame:
    """Version 2: dominant_sentiment replaced by the label of the largest share, the first among equals."""
    p, u, n = (F.col(f"{distribution}.{k}") for k in ("positive", "neutral", "negative"))
    largest = F.when((p >= u) & (p >= n), "positive").when(u >= n, "neutral").when(n.isNotNull(), "negative")
    return df.withColumn("dominant_sentiment", F.coalesce(largest, "dominant_sentiment"))


def normalize_tones(tones: Column) -> Column:
    """Shares divided by their total, six places, the last one what is left of 1; empty and null stay.

    Null where the total isn't above 0 and at most 1.25, which ``semantics_errors`` tells.
    """
    t = total(tones)
    scaled = F.transform(tones, lambda x: x.withField("share", F.round(x["share"] / t, 6)))
    before = total(F.slice(scaled, 1, F.size(scaled) - 1))
    last = F.size(scaled) - 1
    whole = F.transform(scaled, lambda x, i: x.withField("share", F.when(i == last, F.round(1.0 - before, 6)).otherwise(x["share"])))
    return F.when(F.size(tones) == 0, tones).when((t > 0) & (t <= MOST_TONE_TOTAL), whole)


def semantics_errors(df: DataFrame, distribution: str = "estimated_sentiment_distribution") -> Column:
    """Names of the semantic rules that a row breaks, in order; needs the columns of an analysis of version 3.

    Missing tone arrays (version 2) are passed over.
    """
    p, u, n = (F.col(f"{distribution}.{k}") for k in ("positive", "neutral", "negative"))
    dominant, score = F.col("dominant_sentiment"), F.col("sentiment_score")
    share = F.when(dominant == "positive", p).when(dominant == "neutral", u).when(dominant == "negative", n)
    tie = (dominant == "neutral") & (p == n)
    tests = [
        ("distribution_sum", F.abs(p + u + n - 1.0) > TOLERANCE),
        ("dominant_not_largest", ~tie & (F.coalesce(F.abs(share - F.greatest(p, u, n)), F.lit(1.0)) > 0.001)),
        ("score_direction", ((dominant == "positive") & (score <= 0)) | ((dominant == "negative") & (score >= 0))),
    ]
    for name, labels, polarity in (("positive_tones", POSITIVE_TONES, p), ("negative_tones", NEGATIVE_TONES, n)):
        tones = F.col(name)
        names = F.transform(tones, lambda t: t["tone"])
        some = F.size(tones) > 0
        tests += [
            (f"{name}_missing", (F.size(tones) == 0) & (polarity > TOLERANCE)),
            (f"{name}_repeated", some & (F.size(F.array_distinct(names)) < F.size(names))),
            (f"{name}_unknown", some & (F.size(F.array_except(names, F.array(*map(F.lit, labels)))) > 0)),
            (f"{name}_sum", some & (F.abs(total(tones) - 1.0) > TOLERANCE)),
        ]
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in tests]))


def _closed(**fields: dict) -> dict:
    """The schema of an object with exactly these fields."""
    return {"type": "object", "additionalProperties": False, "properties": fields, "required": list(fields)}


def _number(low: float, high: float) -> dict:
    return {"type": "number", "minimum": low, "maximum": high}


def _choice(*labels: str) -> dict:
    return {"type": "string", "enum": list(labels)}


def _texts(most: int, chars: int, least: int = 0) -> dict:
    return {"type": "array", "minItems": least, "maxItems": most, "items": {"type": "string", "minLength": 1, "maxLength": chars}}


def _tones(labels: tuple[str, ...]) -> dict:
    one = _closed(tone=_choice(*labels), share=_number(0, 1), drivers=_texts(*DRIVERS, least=1))
    return {"type": "array", "maxItems": TONES, "items": one}


def schema_document(version: int = 3) -> dict:
    """The JSON Schema of a model's answer in one of the three versions of the contract."""
    told = {name: _texts(*bounds) for name, bounds in LISTS.items()} | {"summary": {"type": "string", "minLength": 1, "maxLength": SUMMARY}}
    spread = {"estimated_sentiment_distribution": _closed(**{k: _number(0, 1) for k in SENTIMENTS}), "polarization": _choice(*POLARIZATIONS), "polarization_score": _number(0, 1)}
    fields = {
        1: {"sentiment": _choice(*SENTIMENTS, "mixed"), "sentiment_score": _number(-1, 1), **told},
        2: {"dominant_sentiment": _choice(*SENTIMENTS), "sentiment_score": _number(-1, 1), **spread, **told},
        3: {**spread, **told, "positive_tones": _tones(POSITIVE_TONES), "negative_tones": _tones(NEGATIVE_TONES)},
    }
    return _closed(**fields[version])


def schema_errors(raw: Column, version: int = 3) -> Column:
    """Names of the schema rules of a version that a JSON text breaks, in the order of the fields; parsing never raises.

    A field that is absent, null or of another type breaks its own rule too. Objects may have no other
    fields than the schema's. Types are strict everywhere: a number in a list of texts is no text.
    """
    return json_schema.errors(raw, schema_document(version))


def top_tones(tones: Column, n: int = 3) -> Column:
    """The ``n`` tones of largest share, equal shares in the order given; null shares count as 0, null arrays are empty."""
    ranked = F.transform(F.coalesce(tones, F.array().cast("array<struct<tone:string,share:double,drivers:array<string>>>")), lambda t, i: F.struct((-F.coalesce(t["share"], F.lit(0.0))).alias("s"), i.alias("i"), t.alias("t")))
    return F.transform(F.slice(F.array_sort(ranked), 1, n), lambda x: x["t"])


def upgrade(df: DataFrame) -> DataFrame:
    """Rows of version 1 with the fields of later ones: ``mixed`` takes its score's side and high polarization."""
    old = F.col("schema_version") == 1
    return df.withColumns(
        {
            "dominant_sentiment": F.when(old & (F.col("sentiment") == "mixed"), F.when(F.col("sentiment_score") > 0, "positive").when(F.col("sentiment_score") < 0, "negative").otherwise("neutral")).otherwise(F.col("sentiment")),
            "polarization": F.when(old, F.when(F.col("sentiment") == "mixed", "high")).otherwise(F.col("polarization")),
        }
    )


def format_tones(tones: Column) -> Column:
    """``name 40% (a; b) · …``; ``-`` for none. Percentages are rounded half to even."""

    def one(t: Column) -> Column:
        drivers = F.filter(F.transform(F.coalesce(t["drivers"], F.array().cast("array<string>")), lambda x: F.trim(x)), lambda d: d != "")
        text = F.when(F.size(drivers) > 0, F.concat(F.lit(" ("), F.array_join(drivers, "; "), F.lit(")"))).otherwise(F.lit(""))
        percent = F.bround(F.coalesce(t["share"], F.lit(0.0)) * 100).cast("long").cast("string")
        return F.concat(F.coalesce(F.when(t["tone"] != "", t["tone"]), F.lit("unknown")), F.lit(" "), percent, F.lit("%"), text)

    return F.when(F.coalesce(F.size(tones), F.lit(0)) <= 0, "-").otherwise(F.array_join(F.transform(tones, one), " · "))

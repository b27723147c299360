"""Schemas of events, messages, analyses and their side tables. Schemas are explicit, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

#: Top-level fields of the event contract, version 1 (fixed values).
EVENT_FIELDS = ("event_id", "source_type", "source_name", "event_time", "collected_at", "language", "title", "text", "url", "community", "engagement", "schema_version", "metadata")

_TYPES = {"engagement": T.LongType(), "schema_version": T.IntegerType(), "metadata": T.MapType(T.StringType(), T.StringType())}
EVENT = T.StructType([T.StructField(f, _TYPES.get(f, T.StringType())) for f in EVENT_FIELDS])
RAW_EVENT = T.StructType([*EVENT.fields, T.StructField("_corrupt_record", T.StringType())])

MESSAGE = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
ARCHIVE_COLUMNS = ("id", "body", "created_utc", "subreddit", "score", "link_id", "controversiality")

TONES = "array<struct<tone:string,share:double,drivers:array<string>>>"
ANALYSIS = (
    "event_id string, custom_id string, model string, prompt_version string, schema_version int, dominant_sentiment string, sentiment_score double, "
    "estimated_sentiment_distribution struct<positive:double,neutral:double,negative:double>, polarization string, polarization_score double, "
    f"positive_tones {TONES}, negative_tones {TONES}, topics array<string>, keywords array<string>, summary string, "
    "usage struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint>"
)

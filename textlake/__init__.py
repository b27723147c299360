"""Part of textlake, a Spark-first engine for timestamped text events."""

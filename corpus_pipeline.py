"""A training corpus from ``documents`` in five stages, each one of the operators of ``textlake.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of ``documents``; the last returns the mix, a row for each time that the mix takes
words of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlake.llm import decontaminate, mixing, ngram_join, quality_rules, toxicity
from textlake.llm.scratch import scope, written

STAGES = [
    ("toxicity", toxicity.stage),
    ("quality_rules", quality_rules.stage),
    ("ngram_jaccard_join", ngram_join.stage),
    ("decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
]

#: Toxicity is a trained network, which SQL cannot express; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written to the shared folder and read by the next.

    The last stage's input stays, as its rows are read from there; all other tables go.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scope(spark):
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}", keep=name == STAGES[-2][0])
    return STAGES[-1][1](spark, docs, sf_dir)

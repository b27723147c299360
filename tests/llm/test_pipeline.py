"""Each stage of the pipeline on its own input, against a brute-force version, on the smallest tables."""

import pytest
import test_decontaminate
import test_mixing
import test_ngram_join
import test_quality_rules

import corpus_pipeline
from textlake.llm import decontaminate, registry, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Input and output rows of each stage."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.written(stage(spark, docs, sf), name)
        out.append((name, docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_columns_and_order(stages):
    assert [n for n, *_ in stages] == ["toxicity", "quality_rules", "ngram_jaccard_join", "decontamination", "mixing"]
    assert all(c == COLUMNS for *_, c in stages[:-1])
    assert all(len(b) < len(a) for _, a, b, _ in stages[:-1])


def test_toxicity_stage(spark, sf, stages):
    _, before, after, _ = stages[0]
    scores = toxicity.learnt(spark, sf).scores([r.text for r in before])
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, s in zip(before, scores) if s < 0.3)


def test_quality_stage(spark, stages):
    _, before, after, _ = stages[1]
    kept = test_quality_rules.brute_kept([(r.text, r.lang, r.source) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, k in zip(before, kept) if k)


def test_near_duplicate_stage(stages):
    _, before, after, _ = stages[2]
    groups = test_ngram_join.brute([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(d for d, n, c in groups if d == c)


def test_decontamination_stage(spark, sf, stages):
    _, before, after, _ = stages[3]
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: decontaminate.normal(r.text) for r in before}
    exact = {d for d, t in texts.items() if any(i in t for i in items)}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert exact <= gone
    for d in gone - exact:
        assert any(test_decontaminate.brute(i, texts[d]) <= 0.1 * len(i) for i in items)


def test_mixing_stage(stages):
    _, before, after, _ = stages[4]
    taken = {}
    for r in after:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    want = {d: k for d, _, _, _, k in test_mixing.brute([(r.doc_id, r.text, r.source) for r in before]) if k}
    assert taken == want


def test_stages_take_no_rows(spark, sf):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0, name


def test_stages_take_odd_rows(spark, sf):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x" * 100_000, None, "s", 1), (3, "a b c d e f g h i j k l", "en", None, 5), (3, "a b c d e f g h i j k l", "de", None, 5)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    twice = [(1, "", "en", "s", 0)] * 2
    want = {"quality_rules": odd[4:], "ngram_jaccard_join": [odd[0], odd[1], odd[3], odd[5]], "decontamination": odd}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = sorted(map(repr, map(tuple, stage(spark, docs, sf).collect())))
        if name == "toxicity":  # texts without words stay; such as these may score as they like
            assert sorted(map(repr, [odd[0], *twice])) == [r for r in got if r[1] in "N1"] and set(got) <= set(map(repr, odd))
        else:
            assert got == sorted(map(repr, want[name])), name
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in mixed} <= {2, 3} and sum(r.taken for r in mixed) == 25


@pytest.mark.parametrize("name", registry.SQL)
def test_query_equals_sql(spark, sf, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    a, b = registry.QUERIES[name](spark, sf), c.sql(registry.SQL[name])
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(repr(tuple(r[x] for x in cols)) for r in a.collect()) == sorted(repr(r) for r in b.select(*cols).fetchall())

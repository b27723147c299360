import hashlib
import json

import pytest
from pyspark.sql import functions as F

from textlake.schemas import EVENT_FIELDS
from textlake.sources import copies as C
from textlake.sources import events as S


def tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file()}


@pytest.fixture
def source(tmp_path):
    for k in range(7):
        f = tmp_path / "a" / f"d{k % 3}" / f"f {k}.bin"
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(bytes([k]) * (k * 100_000))
    return tmp_path / "a"


def test_copies_are_verified_and_made_once(spark, source, tmp_path):
    target = tmp_path / "b"
    first = C.copy_verified(spark, f"file://{source}", f"file://{target}").collect()
    assert {r.status for r in first} == {"copied"} and tree(target) == tree(source)
    assert sorted((r.name, r.length, r.sha256) for r in first) == sorted((n, len(x), hashlib.sha256(x).hexdigest()) for n, x in tree(source).items())
    (target / "d1" / "f 1.bin").write_bytes(b"\x01" * 99_999 + b"x")
    (target / "d2" / "f 5.bin").unlink()
    again = {r.name: r.status for r in C.copy_verified(spark, str(source), str(target)).collect()}
    assert {n for n, s in again.items() if s == "copied"} == {"d1/f 1.bin", "d2/f 5.bin"} and tree(target) == tree(source)


def test_a_copy_that_differs_gets_no_name(source, tmp_path, monkeypatch):
    target, real, calls = tmp_path / "b", C.digest, []

    def lying(system, path, copy_to=None):
        calls.append(path)
        h, n = real(system, path, copy_to)
        return (h, n) if copy_to is not None else ("other", n)

    monkeypatch.setattr(C, "digest", lying)
    with pytest.raises(OSError, match="isn't what was read"):
        C.copy_one(C.opened(str(source)), C.opened(str(target)), "d1/f 4.bin")
    assert tree(target) == {}


def test_digests_of_any_store_spark_opens(spark, source):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.far.link./in", f"file://{source}")
    rows = [sorted(map(tuple, S.file_digests(spark, p).collect())) for p in (f"file://{source}", "viewfs://far/in")]
    assert len(rows[0]) == 7 and rows[1] == [r for r in rows[0] if r[1]]  # Spark's own listing passes over empty files


def event(i, **fields):
    time = "2024-01-01T00:00:00Z"
    return json.dumps(dict.fromkeys(EVENT_FIELDS) | {"event_id": f"{i:064x}", "source_type": "news", "source_name": "gdelt", "event_time": time, "collected_at": time, "language": "en", "text": "t" * 200, "schema_version": 1, "metadata": {}} | fields)


def test_lines_are_numbered_over_splits(spark, tmp_path):
    for k, n in enumerate((1, 900, 40, 0)):
        (tmp_path / f"{k}.txt").write_text("".join(f"{k}-{i}{'x' * (i % 70)}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = S.numbered_lines(spark, str(tmp_path)).collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 941
    for r in rows:
        k, i = r.value.rstrip("x").split("-")
        assert r.file.endswith(f"/{k}.txt") and r.line == int(i) + 1


def test_strict_reads_tell_the_line(spark, tmp_path):
    lines = [event(i) for i in range(300)]
    (tmp_path / "good.jsonl").write_text("\n\n".join(lines))
    assert S.read_jsonl_strict(spark, str(tmp_path / "good.jsonl")).count() == 300
    lines[217] = event(217, event_time="2024-01-01")
    (tmp_path / "bad.jsonl").write_text("\n".join(lines))
    with pytest.raises(Exception, match=r"bad\.jsonl:218: INVALID_EVENT_TIME"):
        S.read_jsonl_strict(spark, str(tmp_path / "bad.jsonl")).agg(F.count("*")).collect()

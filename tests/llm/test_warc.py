import base64
import gzip
import hashlib
import itertools
import tracemalloc

import pytest
from pyspark.sql import functions as F

from textlake.llm import warc as W

LONG = "<p>" + "é payload\r\n\r\nWARC/1.1 " * 20
ROWS = [(5, "http://a/", LONG), (3, "http://b/\r\nX: y", LONG), (9, None, LONG), (None, "http://c/", LONG), (1, "http://d/", "short"), (2, "http://d/", "short"), (4, "", None), (6, "u", ""), (7, "http://big/", "x\r\n" * 900_000), (8, "e", "y" * 100), (8, "e", "y" * 100)]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('warc')}/out"
    W.register(spark)
    W.write(spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, value string").repartition(3), path, rows_per_file=2)
    return path


def load(spark, path, **options):
    return spark.read.format("warc").options(**options).load(path)


def test_round_trip(spark, archive):
    got = load(spark, archive, verify="true").collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.record_id, []).append(r)
    digest = lambda t: "sha256:" + hashlib.sha256((t or "").encode()).hexdigest()
    for page, _, html in ROWS:
        r = by[f"<urn:page:{'none' if page is None else page}>"][0]
        revisit = html == LONG and page != 3
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.payload_digest == digest(html) and r.payload == ("" if revisit else html or "").encode()
        assert r.headers.get("warc-refers-to") == ("<urn:page:3>" if revisit else None)
        assert int(r.headers["x-payload-bytes"]) == len((html or "").encode())
    assert by["<urn:page:3>"][0].target_uri == "http://b/%0A%0AX: y" and by["<urn:page:9>"][0].target_uri is None


def test_pushdown_and_unread_payloads(spark, archive):
    df = W.load_warc(spark, archive, pushdown="true").where("record_type = 'revisit'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "revisit" not in plan  # the predicate is the reader's alone
    assert {r.record_id for r in df.collect()} == {"<urn:page:5>", "<urn:page:9>", "<urn:page:none>"}
    some = W.load_warc(spark, archive, {"WARC-Target-URI": ["http://d/"]}).where(F.col("record_type").isin("response", "x"))
    assert sorted(r.record_id for r in some.collect()) == ["<urn:page:1>", "<urn:page:2>"]
    assert all(r.payload is None and r.content_length >= 0 for r in load(spark, archive, payload="false").collect())


def test_one_frame_with_several_predicates(spark, archive):
    """A loaded frame can be used again and again, also within one query."""
    df = W.load_warc(spark, archive)
    a, b = df.where("record_type = 'revisit'"), df.where("record_type = 'response'")
    assert (df.count(), a.count(), df.count(), b.count(), a.union(b).count(), df.count()) == (11, 3, 11, 8, 11, 11)


def test_damaged_archives_are_told(spark, tmp_path):
    ok = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for i, data in enumerate((ok[:-6], ok.replace(b"3", b"9"), b"nothing\r\n\r\n", ok + b"WARC/1.1\r\nWARC-Ty", ok.replace(b"Length: 3", b"Length: 2"))):
        (tmp_path / f"{i}.warc").write_bytes(data)
        with pytest.raises(Exception, match=f"{i}.warc"):
            load(spark, str(tmp_path / f"{i}.warc")).collect()
    (tmp_path / "good.warc").write_bytes(ok * 2)
    assert [r.payload for r in load(spark, str(tmp_path / "good.warc")).collect()] == [b"abc", b"abc"]


def test_no_rows(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    W.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert load(spark, path).count() == 0


def record(kind, ident, data, *lines):
    head = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: " + ident.encode(), *lines, b"Content-Length: %d" % len(data)]
    return b"\r\n".join(head) + b"\r\n\r\n" + data + b"\r\n\r\n"


def test_payloads_are_bytes_and_headers_have_no_case(spark, tmp_path):
    """Latin-1, compressed and binary payloads, names in any case, continued and repeated lines, odd bytes in headers."""
    image, packed = bytes(range(256)) * 40, gzip.compress(b"page")
    archive = record("warcinfo", "i", b"software: x") + record("response", "a", "café".encode("latin-1")) + record("response", "b", packed, b"warc-TARGET-uri:  http://x/\xff") + record("resource", "c", image, b"X-Note: one", b"\ttwo", b"x-note: three")
    lower = record("response", "d", b"low").replace(b"Content-Length", b"content-length").replace(b"WARC-Type", b"warc-type")
    (tmp_path / "a.warc").write_bytes(archive + lower)
    got = {r.record_id: r for r in load(spark, str(tmp_path / "a.warc")).select("*", W.readable().alias("text")).collect()}
    assert [got[k].payload for k in "abcd"] == ["café".encode("latin-1"), packed, image, b"low"]
    assert got["a"].text == "caf\ufffd" and got["b"].target_uri == "http://x/\ufffd"
    assert got["c"].headers["x-note"] == "one two, three" and got["d"].record_type == "response"
    some = W.load_warc(spark, str(tmp_path / "a.warc"), {"warc-type": ["response"]})
    assert sorted(r.record_id for r in some.collect()) == ["a", "b", "d"]
    assert W.load_warc(spark, str(tmp_path / "a.warc"), pushdown="true").where("record_id IN ('a', 'c')").count() == 2


def test_gzip_with_a_member_a_record(spark, tmp_path):
    parts = [record("response", str(i), bytes([i]) * (i * 700)) for i in range(200)]
    (tmp_path / "m.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    got = load(spark, str(tmp_path / "m.warc.gz")).collect()
    assert sorted((int(r.record_id), r.payload) for r in got) == [(i, bytes([i]) * (i * 700)) for i in range(200)]


def test_digests_of_other_kinds(spark, tmp_path):
    sha1 = base64.b32encode(hashlib.sha1(b"abc").digest())
    good = record("response", "a", b"abc", b"WARC-Block-Digest: sha1:" + sha1, b"WARC-Payload-Digest: sha1:OFTHEBODY", b"Content-Type: application/http; msgtype=response")
    for name, data, ok in (("good", good, True), ("bad", good.replace(b"abc\r\n", b"abd\r\n"), False)):
        (tmp_path / f"{name}.warc").write_bytes(data)
        if ok:
            assert load(spark, str(tmp_path / f"{name}.warc"), verify="true").count() == 1
        else:
            with pytest.raises(Exception, match="warc-block-digest"):
                load(spark, str(tmp_path / f"{name}.warc"), verify="true").collect()


class Huge:
    """A file of one record with a payload of a gigabyte, and one behind it, made while it is read."""

    def __init__(self):
        self.parts = itertools.chain([b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 1073741824\r\n\r\n"], (bytes(1 << 20) for _ in range(1024)), [b"\r\n\r\n" + record("response", "z", b"end")])

    def read(self, n):
        return next(self.parts, b"")


def test_a_gigabyte_is_passed_over_in_little_memory():
    reader = W.WarcReader({"path": "x", "where": '{"WARC-Type": ["response"]}'})
    tracemalloc.start()
    assert [r[6] for r in reader.records(Huge(), "x")] == [b"end"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20


def test_a_record_without_length(spark, tmp_path):
    (tmp_path / "n.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nabc\r\n\r\n")
    with pytest.raises(Exception, match="Content-Length"):
        load(spark, str(tmp_path / "n.warc")).collect()


def test_stores_that_workers_cannot_open(spark, archive):
    """The same records through Spark's file systems; the data source itself tells of the way."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./a", archive)
    far = "viewfs://store/a"
    with pytest.raises(Exception, match="load_warc"):
        load(spark, far).collect()
    key = lambda df: sorted(repr((r.record_id, r.record_type, r.payload, sorted(r.headers.items()))) for r in df.collect())
    assert key(W.load_warc(spark, far, verify="true")) == key(W.load_warc(spark, archive))
    some = W.load_warc(spark, far, {"WARC-Type": ["revisit"]})
    assert some.count() == 3


def test_paths_of_stores():
    assert [W.located(p) for p in ("s3a://b/k", "/a/b", "file:/a", "file:///a", "dbfs:/x/y", "gs://b/k")] == ["s3://b/k", "/a/b", "file:///a", "file:///a", "file:///dbfs/x/y", "gs://b/k"]


def test_joined_digests_give_the_same(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert sorted(W.records(df).collect()) == sorted(W.records(df, broadcast_bytes=0).collect())

"""WARC archives: a writer on Spark's text sink and a Python data source that reads them back.

A record is a block of header lines, an empty line, the payload and two line ends. The pages written
are UTF-8, so the text writer makes valid archives with ``\\r\\n\\r\\n`` between records, and Spark's
committer keeps failed tasks' files out. The reader takes any archive: payloads are bytes (``readable``
makes text of them), header names have no case, gzip files may have a member a record. It plans a
partition a file, parses a record's headers first, tests the pushed predicates on them, and passes
over payloads unread that are not wanted.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from .scratch import delete, fresh, if_small, table, written

END = b"\r\n\r\n"
SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, content_length long, headers map<string,string>, payload binary"
#: Columns that a header gives, and so can be tested before the payload is touched. Names of headers are in lower case.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest"}
ARROW = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("content_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
CHUNK = 1 << 20


class FilePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


#: What pyarrow calls the stores that Spark's paths name; a mount point for the last.
SCHEMES = {"s3a": "s3", "s3n": "s3", "file": "file", "dbfs": "file:///dbfs"}


def located(path: str) -> str:
    """``path`` as pyarrow takes it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    name = SCHEMES.get(scheme, scheme)
    if "//" in name or name == "file":
        return f"{name if '//' in name else 'file://'}/{rest.lstrip('/')}"
    return f"{name}:{rest}"


def opened(path: str):
    """pyarrow's file system of ``path``, and the path in it; an error that says what to do where there is none."""
    try:
        return fs.FileSystem.from_uri(located(path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as e:
        raise ValueError(f"{path}: Python workers can't open this store ({e}); load_warc reads it through Spark's own file systems") from e


class Stream:
    """Sequential reads with a look-ahead buffer of one chunk at most (a payload is held only if asked for)."""

    def __init__(self, source, name: str):
        self.source, self.name, self.buffer, self.at = source, name, b"", 0

    def more(self) -> bool:
        if self.at:
            self.buffer, self.at = self.buffer[self.at :], 0
        got = self.source.read(CHUNK)
        self.buffer += got
        return bool(got)

    def block(self) -> bytes | None:
        """Header lines up to the empty line; None at the end of the file."""
        while (i := self.buffer.find(END, self.at)) < 0:
            if not self.more():
                if self.buffer[self.at :].strip():
                    raise ValueError(f"{self.name}: a record's headers break off")
                return None
        out, self.at = self.buffer[self.at : i], i + len(END)
        return out

    def bytes(self, n: int, each) -> None:
        """Hands the next ``n`` bytes to ``each`` in parts."""
        while n:
            if self.at >= len(self.buffer) and not self.more():
                raise ValueError(f"{self.name}: a payload breaks off")
            part = self.buffer[self.at : self.at + n]
            self.at += len(part)
            n -= len(part)
            each(part)

    def ends(self) -> None:
        end: list[bytes] = []
        self.bytes(len(END), end.append)
        if b"".join(end) != END:
            raise ValueError(f"{self.name}: a record doesn't end where its length says")


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payload, self.verify = options["path"], options.get("payload", "true") == "true", options.get("verify", "false") == "true"
        self.tests: dict[str, set] = {h.lower(): set(v) for h, v in json.loads(options.get("where", "{}")).items()}

    def partitions(self):
        system, at = opened(self.path)
        info = system.get_file_info(at)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(at, recursive=True))
        names = sorted(x.path for x in found if x.type == fs.FileType.File and x.size and not x.base_name.startswith(("_", ".")))
        return [FilePartition(n) for n in names] or [FilePartition("")]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        if partition.path:
            with opened(self.path)[0].open_input_stream(partition.path, compression="gzip" if partition.path.endswith(".gz") else None) as source:
                for row in self.records(source, partition.path):
                    rows.append(row)
                    held += len(row[6] or b"") + 200
                    if held > 4 << 20:
                        yield self.pack(rows)
                        rows, held = [], 0
        yield self.pack(rows)

    def pack(self, rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [[]] * len(ARROW)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, ARROW.types)], schema=ARROW)

    def records(self, source, path: str) -> Iterator[tuple]:
        """Wanted records of the open file ``source``, in the order of ARROW; a payload that isn't wanted is passed over, a chunk at a time.

        A wanted payload is held whole, so one of a gigabyte needs two while its row is made.
        """
        stream = Stream(source, path)
        while (block := stream.block()) is not None:
            headers = parsed(block, path)
            if not headers.get("content-length", "").isdecimal():
                raise ValueError(f"{path}: a record has no Content-Length")
            size = int(headers["content-length"])
            wanted = all(headers.get(h) in values for h, values in self.tests.items())
            checks = digests(headers) if wanted and self.verify else {}
            keep: list[bytes] | None = [] if wanted and self.payload else None

            def each(part: bytes, checks=checks, keep=keep) -> None:
                for h, _ in checks.values():
                    h.update(part)
                if keep is not None:
                    keep.append(part)

            stream.bytes(size, each)
            stream.ends()
            if not wanted:
                continue
            for name, (h, said) in checks.items():
                if said not in (h.hexdigest(), base64.b32encode(h.digest()).decode().lower()):
                    raise ValueError(f"{path}: {headers.get('warc-record-id')}: the payload isn't what {name} says")
            yield (*(headers.get(h) for h in HEADERS.values()), size, list(headers.items()), b"".join(keep) if keep is not None else None)


def parsed(block: bytes, path: str) -> dict[str, str]:
    """Headers of a record by lower-case name. Bytes that aren't UTF-8 read as U+FFFD, continued lines are joined, and so are values of a repeated name, with a comma."""
    first, *lines = block.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"{path}: a record begins with {first[:20]!r}")
    out: dict[str, str] = {}
    last = ""
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return out


def digests(headers: dict[str, str]) -> dict:
    """Running digests to check, with what they should be: the block's, and the payload's where that is the block."""
    whole = headers.get("warc-type") == "response" and not headers.get("content-type", "").startswith("application/http")
    out = {}
    for name in ("warc-block-digest", *["warc-payload-digest"] * whole):
        kind, _, said = headers.get(name, "").lower().partition(":")
        if kind.replace("-", "") in ("sha1", "sha256", "sha512", "md5"):
            out[name] = hashlib.new(kind.replace("-", "")), said.strip()
    return out


def readable(payload: str = "payload") -> Column:
    """A payload as text; bytes that aren't UTF-8 read as U+FFFD."""
    return F.make_valid_utf8(F.col(payload).cast("string"))


class PushingReader(WarcReader):
    """A reader that takes predicates on header columns from Spark."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                name, values = HEADERS[f.attribute[0]], {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.tests[name] = self.tests[name] & values if name in self.tests else values
            else:
                yield f


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; see ``load_warc``.

    Options: ``where``, a JSON object of header names and allowed values, which the reader tests before
    it touches a payload; ``payload`` "false" to leave payloads unread (null); ``verify`` "true" to hold
    responses' payloads against their digests; ``pushdown`` "true" to let Spark hand equality and IN
    predicates on record_type, record_id, target_uri and payload_digest to the reader as well (with
    spark.sql.python.filterPushdown.enabled). The last is for frames that are used with one predicate
    only: Spark 4.1 keeps one read plan for each loaded frame, so a second use with other predicates
    would lack rows. Without it any number of uses are right, and Spark tests the predicates itself.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return (PushingReader if self.options.get("pushdown") == "true" else WarcReader)(self.options)


def register(spark: SparkSession, pushdown: bool = False) -> None:
    """Makes the source known; ``pushdown`` also turns on Spark's push-down to Python sources, for the session."""
    if pushdown:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def load_warc(spark: SparkSession, path: str, where: dict[str, list[str]] | None = None, **options: str) -> DataFrame:
    """Records below ``path``, with the data source's columns and options, from any store that Spark reads.

    ``where`` has header names (in any case) and their allowed values, such as {"WARC-Type": ["response"]}.
    Names in ``headers`` are in lower case.

    Where Python workers can't open the store, files come as binary rows from Spark's own file
    systems and are parsed on the executors: a file is then held in memory, and only ``where`` is
    tested before payloads are decoded.
    """
    options |= {"where": json.dumps(where)} if where else {}
    try:
        opened(path)
    except ValueError:
        reader = WarcReader({"path": path, **options})

        def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for name, content in zip(b["path"].to_pylist(), b["content"]):
                    source = pa.BufferReader(content.as_buffer())
                    yield reader.pack(list(reader.records(pa.CompressedInputStream(source, "gzip") if name.endswith(".gz") else source, name)))

        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "content")
        return files.mapInArrow(parse, SCHEMA)
    register(spark, options.get("pushdown") == "true")
    return spark.read.format("warc").options(**options).load(path)


def records(pages: DataFrame, least: int = 100, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``pages`` (page_id, url, html) as records: wr_* columns and the text of each.

    Null html is an empty payload. Of rows with equal payloads of at least ``least`` bytes those with
    the smallest page_id (one, unless rows are repeated) are responses, the others revisits that refer
    to it; rows without an id never are the smallest unless all are. Smallest ids are aggregated before
    they are dealt, and only digests that occur twice are joined back: broadcast where they take little
    memory, so that payloads stay where they are, else by digest, where AQE splits a payload that a
    third of all rows share. Repeated rows give a record each; an empty table gives none.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("wr_id"),
        F.regexp_replace(F.col("url"), r"[\r\n]", "%0A").alias("wr_url"),
        F.coalesce("html", F.lit("")).alias("wr_payload"),
    ).withColumns({"wr_bytes": F.octet_length("wr_payload").cast("long"), "wr_digest": F.sha2(F.col("wr_payload").cast("binary"), 256)})
    shared = rows.where(F.col("wr_bytes") >= least).groupBy("wr_digest").agg(F.min("wr_id").alias("wr_first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(if_small(written(shared, "warc-shared"), broadcast_bytes), "wr_digest", "left").withColumn("wr_revisit", F.coalesce(F.col("wr_first") != F.coalesce("wr_id", F.col("wr_first") - 1), F.lit(False)))
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    text = F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(F.col("wr_revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", ident("wr_id")),
        F.coalesce(line("WARC-Target-URI", F.col("wr_url")), F.lit("")),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "wr_digest")),
        line("X-Payload-Bytes", F.col("wr_bytes").cast("string")),
        F.when(F.col("wr_revisit"), F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", ident("wr_first")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(F.col("wr_revisit"), F.lit("0")).otherwise(F.col("wr_bytes").cast("string"))),
        F.lit("\r\n\r\n"),
        F.when(F.col("wr_revisit"), F.lit("")).otherwise(F.col("wr_payload")),
    )
    return rows.select(text.alias("value"))


def write(pages: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Archives of ``pages`` below ``path``, gzipped, of at most ``rows_per_file`` records each."""
    records(pages).write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", rows_per_file).text(path)


def query(spark, sf_dir) -> DataFrame:
    """The archive is read back once, its small result is kept, and the archive goes."""
    path = fresh(spark, "warc")
    write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    read = load_warc(spark, path, {"WARC-Type": ["response", "revisit"]}, payload="false", verify="true")
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, 'page:(-?[0-9]+)>', 1) AS BIGINT)")
    out = read.select(
        number("record_id").alias("page_id"),
        F.element_at("headers", "x-payload-bytes").cast("long").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        number("headers['warc-refers-to']").alias("refers_to"),
    )
    out = written(out, "warc-pages")
    delete(spark, path)
    return out


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS m FROM p WHERE b >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, b AS payload_bytes, p.d AS payload_digest,
       CASE WHEN m IS NOT NULL AND page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m IS NOT NULL AND page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""

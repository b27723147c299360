"""A table by key whose upserts are atomic and rewrite only the files that they have to.

Rows lie in files by the bucket of their key's hash. The newest commit names the table's files, and the
batches that are in it, so data and ledger change together. Each file has a bitmap of its keys' hashes.
An upsert first writes its own rows; files whose bitmaps have none of its keys stay as they are, and
where a bucket has no such file at all, the rows just written are its new file. What an upsert writes
follows from its own rows and the files that they hit, not from the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import dedup
from ..session import delete
from .commits import CommitLog

#: Bits of one of Spark's bitmaps (a fixed value), and of a file's bitmaps for each of its rows: about one key in sixteen that isn't there seems to be.
BITMAP_BITS, BITS_A_ROW = 32768, 16


def within(ranges: list[list[int]], number: int) -> bool:
    return any(a <= number <= b for a, b in ranges)


def with_number(ranges: list[list[int]], number: int) -> list[list[int]]:
    """Sorted ranges [first, last] of batch numbers with one more; neighbours join, so batches in order need one range."""
    out: list[list[int]] = []
    for a, b in sorted([*ranges, [number, number]]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


class KeyedStore:
    """The table below ``root``. ``buckets`` is fixed by the first commit; a bucket has several files where it is large.

    Commits list all files, so a table should have few enough buckets that its files are large.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.log = spark, root.rstrip("/"), list(keys), CommitLog(root, spark)
        self.buckets = self.state()["buckets"] if self.log.latest() >= 0 else buckets

    def state(self, number: int | None = None) -> dict:
        """The commit ``number``, or the newest."""
        number = self.log.latest() if number is None else number
        return self.log.read(number) if number >= 0 else {"files": {}, "ledger": {}, "buckets": self.buckets}

    def read(self, number: int | None = None) -> DataFrame:
        """The table as of commit ``number``, or of the newest; an error before the first."""
        files = list(self.state(number)["files"])
        if not files:
            raise ValueError(f"{self.root}: nothing is committed")
        return self._read(files).drop("_bucket")

    def committed(self, writer: str, batch: int) -> bool:
        return within(self.state()["ledger"].get(writer, []), batch)

    def upsert(self, incoming: DataFrame, order: Sequence[Column], first: Sequence[str], latest: Sequence[str], writer: str | None = None, batch: int = 0) -> dict | None:
        """Merges ``incoming`` in by key: ``first`` columns of a key's first row stay, ``latest`` ones are of its last.

        Stored rows come before incoming ones, those by ``order``. With a ``writer``, its ``batch``
        counts once and gets into the ledger in the same commit. Returns rows and files written and kept, None for a batch that is
        there already. If it fails anywhere, the table is as before. Writers at one time don't lose
        each other's rows: whose commit comes second merges again on top of the first.
        """
        if writer and self.committed(writer, batch):
            return None
        name, bucket = self._fresh(), F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        own = self._write(dedup.merge(incoming, self.keys, order, first, latest).withColumn("_bucket", bucket), name)
        for attempt in range(1000):
            number = self.log.latest()
            now = self.state(number)
            if writer and within(now["ledger"].get(writer, []), batch):
                self._remove(name)
                return None
            hit = self._hit(own, now["files"])
            buckets = {now["files"][f]["bucket"] for f in hit}
            mixed = [f for f, x in own.items() if x["bucket"] in buckets]
            merged: dict = {}
            if hit:
                rows = dedup.upsert(self._read(hit), self._read(mixed), [*self.keys, "_bucket"], [], first, latest)
                merged = self._write(rows, f"{name}-{attempt}")
            files = {f: x for f, x in now["files"].items() if f not in hit} | {f: x for f, x in own.items() if f not in mixed} | merged
            ledger = now["ledger"] | ({writer: with_number(now["ledger"].get(writer, []), batch)} if writer else {})
            if self.log.add(number + 1, {"files": files, "ledger": ledger, "buckets": self.buckets}):
                total = lambda x: sum(f["rows"] for f in x.values())
                return {"version": number + 1, "own_rows": total(own), "rewritten_rows": total(merged), "files_kept": len(now["files"]) - len(hit), "files_hit": len(hit), "table_rows": total(files)}
            self._remove(f"{name}-{attempt}")
        raise RuntimeError(f"{self.root}: other writers were always first")

    def compact(self, most_files: int = 8) -> int:
        """Rewrites buckets of more than ``most_files`` files as few; the number of files that were replaced."""
        number = self.log.latest()
        now, by = self.state(number), {}
        for f, x in now["files"].items():
            by.setdefault(x["bucket"], []).append(f)
        many = [f for files in by.values() if len(files) > most_files for f in files]
        if many:
            new = self._write(self._read(many), self._fresh())
            if not self.log.add(number + 1, now | {"files": {f: x for f, x in now["files"].items() if f not in many} | new}):
                return 0  # a writer was first; its files are not in this list
        return len(many)

    def clean(self, keep: int = 1) -> None:
        """Removes what the last ``keep`` commits don't name, as failed writers leave it. Only while nobody writes."""
        last = self.log.latest()
        alive = {f.split("/")[0] for n in range(max(0, last - keep + 1), last + 1) for f in self.state(n)["files"]}
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        for s in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path):
            if (name := s.getPath().getName()) not in alive:
                self._remove(name)

    def _remove(self, name: str) -> None:
        for what in ("data", "filters"):
            delete(self.spark, f"{self.root}/{what}/{name}")

    def _read(self, files: Sequence[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/{f}" for f in files]).withColumn("_bucket", F.col("_bucket").cast("int")).drop("store_write")

    def _position(self, parts: Column | int) -> Column:
        return F.pmod(F.xxhash64(*self.keys, F.lit("bitmap")), F.lit(BITMAP_BITS).cast("long") * parts)

    def _write(self, rows: DataFrame, name: str) -> dict:
        """Writes files and their bitmaps; bucket, rows and number of bitmaps by file."""
        path = f"{self.root}/data/{name}"
        rows.hint("rebalance", "_bucket").write.option("compression", "zstd").partitionBy("_bucket").parquet(path)
        keys = self.spark.read.schema(rows.select(*self.keys, "_bucket").schema).parquet(path).select(*self.keys, "_bucket", F.col("_metadata.file_path").alias("file"))
        found = keys.groupBy("file", "_bucket").agg(F.count("*").alias("n")).collect()  # a row a file
        parts = 1
        while parts * BITMAP_BITS < BITS_A_ROW * max((r.n for r in found), default=0):
            parts *= 2
        at = self._position(parts)
        bits = keys.select("file", "_bucket", F.floor(at / BITMAP_BITS).cast("int").alias("part"), (at % BITMAP_BITS).alias("bit"))
        bits.groupBy("file", "_bucket", "part").agg(F.bitmap_construct_agg("bit").alias("bits")).write.parquet(f"{self.root}/filters/{name}")
        return {self._name(r.file): {"bucket": r._bucket, "rows": r.n, "parts": parts} for r in found}

    @staticmethod
    def _fresh() -> str:
        """Folder of a new write, in the form of a partition, so that files of several can be read together."""
        return f"store_write={uuid.uuid4().hex}"

    @staticmethod
    def _name(path: str) -> str:
        """write/bucket/file, as a commit names a file."""
        return "/".join(unquote(path).split("/")[-3:])

    def _hit(self, own: dict, files: dict) -> list[str]:
        """Of ``files``, those whose bitmaps have one of the keys in ``own``."""
        buckets = {x["bucket"] for x in own.values()}
        met = {f: x for f, x in files.items() if x["bucket"] in buckets}
        if not met:
            return []
        alive = self.spark.createDataFrame([(f, x["bucket"], x["parts"]) for f, x in met.items()], "name string, b int, parts int")
        kept = self.spark.read.parquet(*[f"{self.root}/filters/{w}" for w in sorted({f.split("/")[0] for f in met})])
        kept = kept.withColumn("name", F.array_join(F.slice(F.split("file", "/"), -3, 3), "/")).join(F.broadcast(alive), "name")
        sizes = F.array(*[F.lit(p) for p in sorted({x["parts"] for x in met.values()})])
        asked = self._read(list(own)).select(*self.keys, F.col("_bucket").alias("b"), F.explode(sizes).alias("parts"))
        at = self._position(F.col("parts"))
        asked = asked.select("b", "parts", F.floor(at / BITMAP_BITS).cast("int").alias("part"), (at % BITMAP_BITS).cast("int").alias("bit"))
        byte = F.conv(F.hex(F.substring("bits", F.expr("bit div 8 + 1"), F.lit(1))), 16, 10).cast("int")
        has = F.expr("shiftright(byte, bit % 8) & 1") == 1
        hits = kept.join(asked, ["b", "parts", "part"]).withColumn("byte", byte).where(has)
        return [r.name for r in hits.select("name").distinct().collect()]  # of the table's files

"""Intermediate tables that survive lost executors.

Everything that is needed twice is written as Parquet below the folder that the cluster shares,
``spark.checkpoint.dir``. Only where that setting is absent and the master is local (tests, a laptop)
is a local folder used; on a cluster without the setting the first table raises.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F


def root(spark: SparkSession) -> str:
    """The shared folder of this session."""
    if shared := spark.conf.get("spark.checkpoint.dir", None):
        return shared
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "textlake-checkpoints")


def fresh(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written yet."""
    return f"{root(spark).rstrip('/')}/textlake/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: ``open``: lists of paths that each open scope of this thread removes at its end, innermost last.
_scopes = threading.local()


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written within, in this thread, when it ends, except those written with ``keep``.

    For operators that read their tables many times and return only a last, small one; what they
    return must not read the others. A table that is kept belongs to the scope around, if there is one.
    """
    mine: list[str] = []
    _scopes.open = [*getattr(_scopes, "open", []), mine]
    try:
        yield
    finally:
        _scopes.open = _scopes.open[:-1]
        for path in mine:
            delete(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, and no executor holds the only copy."""
    spark = df.sparkSession
    path, scopes = fresh(spark, name), getattr(_scopes, "open", [])
    if keep:
        scopes = scopes[:-1]
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """``df``, a written table, to be broadcast if its rows take at most ``most_bytes``, else as it is, to be joined by key.

    Each row counts with its texts' and byte strings' lengths and 40 bytes more, and 8 for each
    other column: about what a hash table of it takes.
    """
    width = F.lit(40 + 8 * len(df.columns)).cast("long")
    for c, kind in df.dtypes:
        width = width + F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) if kind in ("string", "binary") else width
    size = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first().b
    return F.broadcast(df) if size <= most_bytes else df


def apart(names: list[str], taken: tuple[str, ...]) -> list[str]:
    """``names``, each with as many underscores behind it as keep it from those ``taken`` (case aside) and from each other."""
    out: list[str] = []
    for name in names:
        while name.lower() in {x.lower() for x in (*taken, *out)}:
            name += "_"
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

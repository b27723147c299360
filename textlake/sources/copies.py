"""Copies of files between stores that Python workers can open, a file a row, each verified by its digest."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

#: Bytes that a task holds of a file.
CHUNK = 8 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path in it."""
    scheme, colon, rest = path.partition(":")
    if colon and "/" not in scheme and not rest.startswith("//"):
        path = f"{scheme}://{rest}"
    return fs.FileSystem.from_uri(path)


def reachable(path: str) -> bool:
    try:
        opened(path)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def names(spark: SparkSession, path: str) -> DataFrame:
    """(name, length) of the files below ``path``, empty ones too, from the listing alone, spread over tasks; files and folders that begin with ``.`` or ``_`` are none, as for Spark."""
    system, base = opened(path)
    found = [(x.path[len(base.rstrip("/")) + 1 :], x.size) for x in system.get_file_info(fs.FileSelector(base, recursive=True)) if x.type == fs.FileType.File]
    found = [(n, size) for n, size in found if not any(part.startswith((".", "_")) for part in n.split("/"))]
    rows = spark.createDataFrame(found, "name string, length long")
    return rows.repartition(min(max(1, len(found)), 4 * spark.sparkContext.defaultParallelism), "name")


def digest(system: fs.FileSystem, path: str, copy_to=None) -> tuple[str, int]:
    """SHA-256 and length of a file, read in parts; each part goes to ``copy_to`` as well."""
    h, n = hashlib.sha256(), 0
    with system.open_input_stream(path) as source:
        while part := source.read(CHUNK):
            h.update(part)
            n += len(part)
            if copy_to is not None:
                copy_to.write(part)
    return h.hexdigest(), n


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(name, length, sha256) of the files below ``path``, of any length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = opened(path)
        for b in batches:
            made = [digest(system, f"{base.rstrip('/')}/{n}") for n in b["name"]]
            yield pd.DataFrame({"name": b["name"], "length": [n for _, n in made], "sha256": [h for h, _ in made]})

    return names(spark, path).mapInPandas(run, "name string, length long, sha256 string")


def copy_one(source: tuple[fs.FileSystem, str], target: tuple[fs.FileSystem, str], name: str) -> tuple[str, int, str]:
    """Digest, length and status of one file: ``same`` if the target has it already, else ``copied``.

    The copy gets its name when what was written has been read back and is the source's, so a target
    never has half a file under a name, whichever of several tasks comes last.
    """
    (a, there), (b, here) = source, target
    there, here = f"{there.rstrip('/')}/{name}", f"{here.rstrip('/')}/{name}"
    info = b.get_file_info(here)
    if info.type == fs.FileType.File and info.size == a.get_file_info(there).size and digest(b, here) == (want := digest(a, there)):
        return *want, "same"
    b.create_dir(os.path.dirname(here), recursive=True)
    draft = f"{os.path.dirname(here)}/.{os.path.basename(here)}.{uuid.uuid4().hex}"
    try:
        with b.open_output_stream(draft) as out:
            want = digest(a, there, out)
        if digest(b, draft) != want:
            raise OSError(f"{name}: what was written isn't what was read")
        b.move(draft, here)
    finally:
        if b.get_file_info(draft).type == fs.FileType.File:
            b.delete_file(draft)
    return *want, "copied"


def copy_verified(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(name, length, sha256, status) of the files below ``source``, which are copied to ``target`` when this is read; files that are there already are only compared."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = opened(source), opened(target)
        for batch in batches:
            made = [(n, *copy_one(a, b, n)) for n in batch["name"]]
            yield pd.DataFrame(made, columns=["name", "sha256", "length", "status"])[["name", "length", "sha256", "status"]]

    return names(spark, source).mapInPandas(run, "name string, length long, sha256 string, status string")

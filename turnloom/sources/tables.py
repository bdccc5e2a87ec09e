"""Span tables from data frames, bytes, files and folders; a format is told by its first bytes."""

from __future__ import annotations

import io
import os
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.tables import shared_dir
from . import sheet

#: Signatures of the accepted formats.
SIGNATURES = {b"PAR1": "parquet", b"PK\x03\x04": "xlsx"}


def sniff(head: bytes) -> str | None:
    """The format that a file's first bytes tell, or None."""
    return next((name for magic, name in SIGNATURES.items() if head.startswith(magic)), None)


def _at(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them; a bare path is a local one."""
    text = path if "://" in path else Path(path).absolute().as_uri()
    at = spark._jvm.org.apache.hadoop.fs.Path(text)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _head(fs, at, n: int = 4) -> bytes:
    """The first bytes of a file on any file system."""
    stream = fs.open(at)
    try:
        read = [stream.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in read if b >= 0)


def _read_all(spark: SparkSession, fs, at) -> bytes:
    """A whole file; for workbooks, which one process parses."""
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def _xlsx(spark: SparkSession, data: bytes) -> DataFrame:
    """First sheet of a workbook, all columns as text; a workbook is bounded by its format (1,048,576 rows)."""
    header, *rows = sheet.read(data) or [[]]
    names = [h or f"column{i}" for i, h in enumerate(header)]
    schema = StructType([StructField(n, StringType()) for n in names])
    width = len(names)
    return spark.createDataFrame([tuple((r + [None] * width)[:width]) for r in rows], schema)


def _bytes_parquet(spark: SparkSession, data: bytes) -> DataFrame:
    """A Parquet blob, spooled to the shared folder so that every executor can read it."""
    jvm = spark._jvm
    path = f"{shared_dir(spark).rstrip('/')}/blob-{uuid.uuid4().hex}.parquet"
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(at)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    fs.deleteOnExit(at)
    return spark.read.parquet(path)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _folder(spark: SparkSession, path: str, port: str) -> DataFrame:
    """All parts of a folder, by their signatures, on any file system; names that begin with a dot are hidden."""
    fs, root = _at(spark, path)
    base, found, listed = root.toUri().getPath().rstrip("/"), [], fs.listFiles(root, True)
    while listed.hasNext():
        at = listed.next().getPath()
        inner = at.toUri().getPath()[len(base) + 1 :]
        if any(part.startswith(".") for part in inner.split("/")):
            continue
        if kind := sniff(_head(fs, at)):
            found.append((inner, kind, at))
    if not found:
        raise FileNotFoundError(f"{port}: no table in the folder {path}")
    found.sort(key=lambda f: f[0])
    parquet = [_visible(spark, fs, at) for _, kind, at in found if kind == "parquet"]
    frames = [spark.read.option("mergeSchema", "true").parquet(*parquet)] if parquet else []
    return _union(frames + [_xlsx(spark, _read_all(spark, fs, at)) for _, kind, at in found if kind == "xlsx"])


def _visible(spark: SparkSession, fs, at) -> str:
    """The path of a part; one whose name begins with an underscore, which Spark's listing skips, is copied to the
    shared folder, stream to stream."""
    if not any(part.startswith("_") for part in at.toUri().getPath().split("/")):
        return at.toString()
    jvm = spark._jvm
    copy = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/part-{uuid.uuid4().hex}.parquet")
    conf = spark._jsc.hadoopConfiguration()
    target = copy.getFileSystem(conf)
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, target, copy, False, conf)
    target.deleteOnExit(copy)
    return copy.toString()


def read_table(spark: SparkSession, value: object, port: str = "table") -> DataFrame:
    """A DataFrame from a Spark or pandas frame, a list of dicts, bytes, a file or a folder of parts.

    A path with a scheme (hdfs://, s3a://, file://, ...) is listed and read by the file system of that scheme, as
    a local one is.  ValueError: unknown format; FileNotFoundError: nothing to read; TypeError: not a table.
    """
    if isinstance(value, DataFrame):
        return value
    if hasattr(value, "iloc") and hasattr(value, "columns"):
        return spark.createDataFrame(value)
    if isinstance(value, list) and value and all(isinstance(r, dict) for r in value):
        names = list(dict.fromkeys(k for r in value for k in r))
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in value], names)
    if isinstance(value, bytes | bytearray):
        return _BY_KIND_BYTES.get(sniff(bytes(value[:8])), _unknown(port))(spark, bytes(value))
    if isinstance(value, str | os.PathLike):
        fs, at = _at(spark, os.fspath(value))
        if not fs.exists(at):
            raise FileNotFoundError(f"{port}: {value} doesn't exist")
        if fs.getFileStatus(at).isDirectory():
            return _folder(spark, os.fspath(value), port)
        kind = sniff(_head(fs, at))
        if kind == "parquet":
            return spark.read.parquet(_visible(spark, fs, at))
        return _xlsx(spark, _read_all(spark, fs, at)) if kind else _unknown(port)(spark, value)
    raise TypeError(f"{port}: {type(value).__name__} is not a table")


def _unknown(port: str) -> Callable:
    def fail(spark: SparkSession, source: object) -> DataFrame:
        raise ValueError(f"{port}: neither Parquet nor xlsx")

    return fail


_BY_KIND_BYTES = {"parquet": _bytes_parquet, "xlsx": _xlsx}


def parquet_bytes(df: DataFrame) -> bytes:
    """One Parquet blob of a result small enough for one process; larger ones are written with df.write."""
    buffer = io.BytesIO()
    pq.write_table(df.toArrow(), buffer)
    return buffer.getvalue()

"""Shared plumbing of the operators: intermediate tables, ids, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import cut, shared_dir

__all__ = ["GAP", "WORD", "crc_mod", "cut", "documents", "map_batches", "packed", "row_key", "shared_dir", "unpacked"]

#: Java regex of one word, and of what lies between words.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the id's decimal text, modulo m; null for a null id."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(m)


def row_key(*columns: str) -> dict[str, Column]:
    """Two columns, 128 bits, that identify a row by these columns, nulls told apart."""
    cols = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return {"k1": F.xxhash64(F.lit(1), *cols), "k2": F.xxhash64(F.lit(2), *cols)}


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, *columns: str, **own: Column) -> DataFrame:
    """The caller's row (these columns of it, or all) in one struct `row`, beside an operator's own columns.

    Whatever the caller's columns are named, none meets a column of the operator.
    """
    return df.select(F.struct(*map(quoted, columns or df.columns)).alias("row"), *[c.alias(k) for k, c in own.items()])


def unpacked(*columns: str) -> list[Column]:
    """The caller's columns out of `row`."""
    return [F.col("row").getField(c).alias(c) for c in columns]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df

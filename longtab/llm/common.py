"""Helpers shared by the corpus operators: table access, bounded labelled samples, batch slicing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters a task expands to code-point arrays at once (4 bytes a code point and a few work arrays).
CHUNK_CHARS = 1_000_000

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id as text, as a long."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def hashed_sample(df: DataFrame, key: str, bound: int, seed: str) -> DataFrame:
    """At most ``bound`` rows: those with the smallest hash of (seed, key).

    A top-k by a hash (each task keeps its own ``bound`` smallest, then they merge), so the sample
    is the same on every run, has a proven size, and depends on no order of the input."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(bound)


def hashed_texts(df: DataFrame, text: str, bound: int, seed: str) -> DataFrame:
    """At most ``bound`` distinct texts, those with the smallest hashes: ``(text)``.

    The hashes are ranked without the texts; only texts at or below the last rank's hash move, each once
    (copies meet in a pre-aggregation), so what is gathered does not grow with the input."""
    keyed = df.select(F.col(text).alias("text"), F.xxhash64(F.lit(seed), F.col(text)).alias("hash"))
    last = keyed.select("hash").distinct().orderBy("hash").limit(bound).agg(F.max("hash")).first()[0]
    near = keyed.where(F.col("hash") <= (last if last is not None else 0))
    return near.groupBy("hash").agg(F.first("text").alias("text")).orderBy("hash").limit(bound).select("text")


def by_chars(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of consecutive texts holding about ``limit`` characters (one text at least)."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > limit:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def texts_of(batch: pa.RecordBatch, col: str = "text") -> list[str]:
    """The text column as str; null becomes the empty text."""
    return [t or "" for t in batch.column(col).to_pylist()]


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` over slices of about CHUNK_CHARS characters of ``text`` (one row at least), so a
    task's arrays stay bounded; ``make`` gives the output columns of a slice.  Arrow keeps null ids
    and 64-bit ids exact."""
    def run(batches):
        for batch in batches:
            texts = texts_of(batch)
            for a, b in by_chars(texts):
                cols = make(batch.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in cols.values()],
                                                 names=list(cols))
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that clash with no column of ``df``."""
    held, tail = {c.lower() for c in df.columns}, "_"
    while any(n + tail in held for n in names):
        tail += "_"
    return [n + tail for n in names]


def clipped(df: DataFrame, names: list[str]) -> DataFrame:
    """Only ``names``, in that order: extra columns, whatever they are called, don't matter."""
    return df.select(*[F.col(f"`{n}`") for n in names])

"""What several of the operators share: tables, Arrow chunks, caches of a worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a chunk given to a Python function holds, unless one row has more.
CHUNK_BYTES = 8 << 20
#: A filter of keys has so many longs, 4 MB; with more keys than its 2^25 bits more rows pass
#: it and are shuffled, with the same result.
FILTER_WORDS = 1 << 19


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for all its tasks."""
    holder = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    return vars(holder).setdefault(name, {})


def bounded(cache: dict, entries: int) -> dict:
    """The cache, emptied first if it holds more than ``entries``."""
    if len(cache) > entries:
        cache.clear()
    return cache


def chunks(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of column number ``text`` stay near ``limit``
    bytes in each; a longer text is a chunk of its own. No row is lost or cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + limit, "right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 texts, empty for null."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def map_text(
    df: DataFrame, columns: list[str], text: str, make: Callable[[], Callable], schema: str
) -> DataFrame:
    """Run a function over the rows in Arrow chunks. ``make`` is called once per task and
    returns a function from a chunk with ``columns`` (the text last) to the arrays of
    ``schema``. One row comes out for each row that goes in, in the same order."""
    given = df.select(*[F.col(c) for c in columns], F.col(text).alias("__text"))
    names = [part.split()[0] for part in schema.split(",")]
    at = len(columns)

    def run(batches):
        f = make()
        for chunk in chunks(batches, at):
            yield pa.RecordBatch.from_arrays(list(f(chunk)), names=names)

    return given.mapInArrow(run, schema)


def may_be_among(column: str, keys: DataFrame) -> Column:
    """Whether a long column may be one of the keys, the only column of ``keys``: one bit per slot
    of a hash, ``FILTER_WORDS`` longs whatever the number of keys. No key is left out."""

    def slot(key):
        return F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))

    own = slot(keys.columns[0])
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (own % 64).cast("int"))
    words = keys.groupBy(F.floor(own / 64).cast("int").alias("w")).agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("w"))
    full = every.join(words, "w", "left").agg(
        F.sort_array(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("a"))
    filled = full.select(F.transform("a", lambda x: x["bits"])).scalar()
    word = F.get(filled, F.floor(slot(column) / 64).cast("int"))
    return F.call_function("getbit", word, (slot(column) % 64).cast("int")) == 1


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)

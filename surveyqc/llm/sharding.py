"""Shards along a Hilbert curve over document metadata.

Language, source and length are quantised to a few bits each, which gives a cell of a
small cube. Rows are ordered by the cell's place on the Hilbert curve, and the order is cut into
runs of equal numbers of rows, so a shard covers few values of every dimension and
files can be skipped by any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyqc.sources.scratch import materialize

#: Bits per dimension; the cube has 8**BITS cells.
BITS = 4
#: Rows that are numbered in one group; a cell with more is spread over several.
GROUP_ROWS = 20_000


def hilbert_index(cell: tuple[int, ...], bits: int) -> int:
    """Place of a cell on the curve, by undoing the rotations from the highest bit down."""
    x = list(cell)
    high = 1 << (bits - 1)
    q = high
    while q > 1:
        for i in range(len(x)):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                swap = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = 0, high
    while q > 1:
        if x[-1] & q:
            turn ^= q - 1
        q >>= 1
    place = 0
    for bit in range(bits - 1, -1, -1):
        for value in x:
            place = place << 1 | ((value ^ turn) >> bit) & 1
    return place


def quantised(docs: DataFrame, lang: str, source: str, size: Column, bits: int) -> Column:
    """Number of a row's cell. Categories go to a bin by hash, sizes by their logarithm."""
    bins = 1 << bits
    category = lambda c: F.pmod(F.xxhash64(c), F.lit(bins)) if c in docs.columns else F.lit(0)
    length = F.least(F.floor(F.log2(size.cast("double"))).cast("long"), F.lit(bins + 2)) - 3  # a size is 8 at least
    return (category(lang) * bins + category(source)) * bins + F.greatest(length, F.lit(0))


def hilbert_shards(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source", bits: int = BITS,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and curve, one row per row.

    ``size`` is 8 plus the UTF-8 bytes of the text, 0 for null; ``text_crc32`` is 0 for a null text.
    The law is ``rows``: the numbers of rows of any two shards differ by one at most. ``slot`` numbers the rows of
    a shard from 0 in the order of the curve, within a cell by group, id and checksum.
    ``grown_shard`` is null. A null or absent language or source is a value like others.
    Rows that are equal in id and text are interchangeable and get slots of their own.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + 8
    rows = materialize(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), size.alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            quantised(docs, lang_col, source_col, size, bits).alias("cell"),
        ),
        "shard-rows",
    )
    bins = range(1 << bits)
    places = [
        ((a * len(bins) + b) * len(bins) + c, hilbert_index((a, b, c), bits)) for a in bins for b in bins for c in bins
    ]
    curve = F.broadcast(spark.createDataFrame(places, "cell long, curve long"))  # 8**bits rows
    per_cell = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).join(curve, "cell")
    groups = F.ceil(F.col("n") / GROUP_ROWS).cast("long")
    per_cell = F.broadcast(per_cell.select("cell", "curve", groups.alias("groups")))
    placed = rows.join(per_cell, "cell").select(
        "doc_id", "size", "text_crc32", "curve",
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("groups")).alias("part"),
    )
    placed = materialize(placed, "shard-placed")
    counts = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = counts.groupBy("curve").agg(F.sum("n").alias("n"))  # 8**bits rows at most
    cells = cells.select("curve", upto(Window.orderBy("curve")).alias("cell_first"))
    counts = counts.select("curve", "part", upto(Window.partitionBy("curve").orderBy("part")).alias("part_first"))
    firsts = materialize(counts.join(cells, "curve"), "shard-firsts")
    in_part = Window.partitionBy("curve", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = placed.withColumn("nth", F.row_number().over(in_part) - 1).join(firsts, ["curve", "part"])
    rank = F.col("cell_first") + F.col("part_first") + F.col("nth")
    total = rows.count()
    least, more = divmod(total, shards)  # the first ``more`` shards have one row more
    ranked = ranked.withColumn("rank", rank)
    in_long = F.col("rank") < more * (least + 1)
    after = F.col("rank") - more * (least + 1)
    shard = F.when(in_long, F.floor(F.col("rank") / (least + 1))).otherwise(F.floor(after / max(least, 1)) + more)
    slot = F.when(in_long, F.pmod("rank", F.lit(least + 1))).otherwise(F.pmod(after, F.lit(max(least, 1))))
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write_shards(docs: DataFrame, shards_of: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents in one folder per shard, sorted by slot, so that readers can
    skip files by the ranges of their columns. Ids must be unique and not null."""
    place = shards_of.select(F.col("doc_id").alias(id_col), "shard", "slot")
    docs.join(place, id_col).repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

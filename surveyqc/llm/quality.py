"""Quality rules with a hashed n-gram likelihood ratio, in DataFrame functions only.

Words and neighbouring word pairs are hashed into buckets. Two multinomials are counted
over them in one pass: all documents, and those that are trusted. A document's score is
the mean logarithm of the ratio of the two, so it is 0 for text like the whole corpus,
above for text that trusted documents have more of, and below for text they lack. All
documents are scored by one threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.common import may_be_among
from surveyqc.operators.once import with_once

#: White space between words, and symbols that are counted; fixed values.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: The model is one float per bucket, 1 MB, whatever the corpus. A power of two.
BUCKETS = 1 << 18
#: Added to both counts of a bucket, so that rare n-grams say little.
SMOOTHING = 5.0
THRESHOLD = -0.1
_POSITION = (1 << 31) - 1


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _next(i: Column, step: int) -> Column:
    """The hash of the word ``step`` places on, with its bits moved so that order counts."""
    return F.call_function("shiftrightunsigned", F.get(F.col("__hashes"), i + step), F.lit(13 * step))


def _same(array: str, i: Column, key) -> Column:
    """Whether the element at i has the key of a neighbour in a sorted array."""
    own = key(F.get(F.col(array), i))
    near = [F.coalesce(own == key(F.get(F.col(array), i + step)), F.lit(False)) for step in (-1, 1)]
    return near[0] | near[1]


def with_statistics(df: DataFrame, text: Column) -> DataFrame:
    """Adds __hashes, n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Repeated windows are found inside a row: hashes of all three-word windows are sorted
    with their positions in the low bits, those that have an equal neighbour are compared
    as texts, and the words that the really equal ones cover are counted.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = with_once(
        df, __words=words(text), __lines=lines,
        n_symbols=(F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
    )
    df = with_once(df, __hashes=hashes(F.col("__words")))
    n = F.size("__words")
    at = lambda i, k: F.get(F.col("__words"), i + k)
    mixed = lambda h, i: h.bitwiseXOR(_next(i, 1)).bitwiseXOR(_next(i, 2))
    hashed = F.transform(
        F.slice("__hashes", F.lit(1), n - 2),
        lambda h, i: F.shiftleft(mixed(h, i), 31).bitwiseOR(i.cast("long")),
    )
    df = with_once(
        df, n_words=n.cast("long"),
        word_chars=F.length(F.array_join("__words", "")).cast("long"),
        n_dup_lines=(F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        __windows=F.when(n >= 3, F.sort_array(hashed)).otherwise(F.array().cast("array<long>")),
    ).drop("__lines")
    likely = F.filter("__windows", lambda _, i: _same("__windows", i, lambda x: F.shiftright(x, 31)))
    df = with_once(df, __likely=F.transform(likely, lambda x: x.bitwiseAND(F.lit(_POSITION)).cast("int"))).drop("__windows")
    texts = F.transform(
        "__likely", lambda p: F.struct(F.concat_ws(" ", at(p, 0), at(p, 1), at(p, 2)).alias("t"), p.alias("p"))
    )
    df = with_once(df, __texts=F.sort_array(texts)).drop("__likely")
    equal = F.filter("__texts", lambda _, i: _same("__texts", i, lambda x: x["t"]))
    starts = F.sort_array(F.transform(equal, lambda x: x["p"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, p: F.struct((s["n"] + p + 3 - F.greatest(p, s["end"])).alias("n"), (p + 3).alias("end")),
    )
    return with_once(df, n_repeat_words=covered["n"].cast("long")).drop("__texts", "__words")


def _buckets(h: Column, i: Column, count: int) -> tuple[Column, Column]:
    """Bucket of a word, and of it and the next word; null for the second at the end."""
    own = lambda x: x.bitwiseAND(F.lit(count - 1).cast("long")).cast("int")
    return own(h), own(h.bitwiseXOR(_next(i, 1)))


def _counted(texts: DataFrame, name: str, count: int) -> DataFrame:
    """How often each bucket occurs in the texts."""
    hashed = with_once(texts, __h=hashes(words(F.col("__text"))))
    pairs = F.arrays_zip(F.col("__h").alias("h"), F.slice("__h", F.lit(2), F.greatest(F.size("__h"), F.lit(1))).alias("n"))
    grams = hashed.select(F.inline(pairs).alias("h", "n"))
    bucket = lambda h: h.bitwiseAND(F.lit(count - 1).cast("long")).cast("int")
    both = F.array(bucket(F.col("h")), bucket(F.col("h").bitwiseXOR(F.call_function("shiftrightunsigned", F.col("n"), F.lit(13)))))
    return grams.select(F.explode(both).alias("b")).filter("b is not null").groupBy("b").agg(F.count(F.lit(1)).alias(name))


def ratios(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, count: int) -> DataFrame:
    """One row with the array of all buckets' log ratios.

    ratio = (trusted count + s) / (raw count scaled to the trusted total + s).

    The raw side is counted without a join. For the trusted side only texts that pass a
    filter of the trusted ids are shuffled to the join with them.
    """
    ids = trusted.select(F.col(id_col).cast("long").alias("__id")).filter("__id is not null").distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    likely = rows.filter(F.col("__id").isNotNull() & may_be_among("__id", ids))
    good = likely.join(ids.hint("merge"), "__id", "left_semi").select("__text")
    counts = _counted(rows.select("__text"), "raw", count).join(_counted(good, "good", count), "b", "left")
    every = docs.sparkSession.range(count).select(F.col("id").cast("int").alias("b"))
    full = every.join(counts, "b", "left").select(
        "b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good")
    )
    one = full.agg(
        F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"),
        F.sort_array(F.collect_list(F.struct("b", "raw", "good"))).alias("cells"),
    )
    scale = F.when(F.col("all_raw") > 0, F.col("all_good") / F.col("all_raw")).otherwise(F.lit(0.0))
    ratio = lambda c: F.log((c["good"] + F.lit(SMOOTHING)) / (c["raw"] * F.col("scale") + F.lit(SMOOTHING)))
    return one.withColumn("scale", scale).select(F.transform("cells", lambda c: ratio(c).cast("float")).alias("m"))


def quality_rules(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD, count: int = BUCKETS, keep_columns: bool = False,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    score and kept, one row per row; with ``keep_columns`` all columns of the documents
    and then these but the first.

    ``trusted`` has the ids of trusted documents. ``base_failed`` is fewer than 50 words,
    or more than half of them in repeated three-word windows; ``kept`` is that this is not so and
    the score is at least ``threshold``.

    A null, empty or blank text has no words, all counts 0, score 0 and fails. With no
    trusted ids, or none that occur, all scores are those of equal multinomials: 0. Null
    ids are never trusted; rows that repeat an id are all trusted if it is. Repeated rows
    are counted and answered each.
    """
    own = F.col(id_col).cast("long").alias("doc_id")
    given = [F.col(f"`{c}`") for c in docs.columns] if keep_columns else [own]
    df = with_statistics(docs.select(F.struct(*given).alias("__row"), F.col(text_col).alias("__text")), F.col("__text")).drop("__text")
    model = ratios(docs, trusted, id_col, text_col, count).scalar()

    def ratio(h: Column, i: Column) -> Column:
        single, double = (F.get(F.col("__model"), b) for b in _buckets(h, i, count))
        return single + F.coalesce(double, F.lit(0.0))

    total = F.aggregate(F.transform("__hashes", ratio), F.lit(0.0), lambda s, x: s + x)
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    df = df.withColumn("__model", model).withColumn("__score", total / grams).drop("__hashes", "__model")
    df = with_once(df, score=F.col("__score"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    names = docs.columns if keep_columns else ["doc_id"]
    return df.select(
        *[F.col(f"__row.`{c}`").alias(c) for c in names],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "score", (~failed & (F.col("score") >= threshold)).alias("kept"),
    )

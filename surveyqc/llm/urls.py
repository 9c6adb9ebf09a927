"""URL filter by rules, a blocked Bloom filter and an exact join, in DataFrame functions only.

Listed URLs are brought to a canonical form and hashed into blocks of four 64-bit words;
an entry sets one bit in each word of its block. The blocks are at most ``MAX_BLOCKS`` rows, which are
broadcast. A page whose bits are all set is a possible hit; those alone are shuffled to a join with the
listed URLs, which removes the false ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Blocks of 256 bits; 2**17 blocks of 40 bytes are about 5 MB to broadcast.
MAX_BLOCKS = 1 << 17
#: Bits of the filter per listed URL, until the blocks are at their most.
BITS_PER_URL = 16

#: Rules as (verdict, host, path); the longest that fits a URL decides.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(F.when(F.instr(url, "://") > 0, host).otherwise(F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    path = F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and path without slashes at its end; scheme, query and fragment do not count."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))


def _bits(key: str) -> list[Column]:
    """One set bit for each of the four words of a block."""
    h = F.xxhash64(F.lit(7), F.col(key))
    return [_bit(F.shiftright(h, 6 * i).bitwiseAND(F.lit(63))) for i in range(4)]


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0 to w3) for each block that has entries."""
    words = [bit.alias(f"b{i}") for i, bit in enumerate(_bits(key))]
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")
    return listed.select(block, *words).groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(4)])


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
    listed_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict and listed, one row per row.

    The verdict is that of the longest rule whose host is the page's or a parent domain of
    it and whose path begins the page's; without one, ``block`` if the canonical URL is
    listed, else ``allow``. A null URL or one without ``://`` has an empty host and path,
    fits no rule and is never listed. Listed URLs may be null, repeated or unparsable;
    only those with a host count. Pages that repeat are answered each.
    """
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"),
    ).withColumn("key", canonical(F.col("host"), F.col("path")))
    key = canonical(host_of(F.col(listed_col)), path_of(F.col(listed_col)))
    entries = listed.select(key.alias("key")).filter("key != ''").distinct()
    wanted = entries.count() * BITS_PER_URL // 256
    blocks = min(1 << max(wanted.bit_length(), 4), MAX_BLOCKS)
    tested = rows.join(
        F.broadcast(bloom(entries, "key", blocks)), F.pmod(F.xxhash64("key"), F.lit(blocks)) == F.col("block"), "left"
    )
    possible = F.col("block").isNotNull() & (F.col("host") != "")
    for i, bit in enumerate(_bits("key")):
        possible = possible & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    tested = tested.withColumn("possible", F.coalesce(possible, F.lit(False))).select("page_id", "host", "path", "key", "possible")
    hits = tested.filter("possible").join(entries.withColumn("listed", F.lit(True)), "key", "left")
    hits = hits.select("page_id", "host", "path", F.coalesce("listed", F.lit(False)).alias("listed"))
    rest = tested.filter("not possible").select("page_id", "host", "path", F.lit(False).alias("listed"))
    judged = hits.union(rest)
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), "block").otherwise("allow")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest last, so outermost
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")

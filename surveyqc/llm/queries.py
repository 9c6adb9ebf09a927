"""One query per operator, over its whole table: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.alignment import align_documents
from surveyqc.llm.bpe import bpe_round_trip
from surveyqc.llm.chat_format import format_conversations, read_conversations
from surveyqc.llm.classifier import quality_scores
from surveyqc.llm.common import sha256_hex, table
from surveyqc.llm.decontaminate import decontaminate
from surveyqc.llm.near_dedup import near_duplicates
from surveyqc.llm.personal import personal_data
from surveyqc.llm.prefix_trie import conversation_paths, prefix_trie
from surveyqc.llm.quality import quality_rules
from surveyqc.llm.records import record_round_trip
from surveyqc.llm.secret_scan import find_secrets
from surveyqc.llm.sharding import hilbert_shards
from surveyqc.llm.urls import filter_urls
from surveyqc.sources.scratch import materialize

QUERIES = {}
ORACLES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def held_out(doc_id: Column) -> Column:
    """One in five rows, by the checksum of the id; never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def trusted_documents(spark, sf: str) -> DataFrame:
    """Ids that are labelled as good and may be learnt from."""
    labels = table(spark, sf, "labels")
    return labels.filter((F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select("doc_id")


@query
def op1_near_dedup(spark, sf: str) -> DataFrame:
    found = near_duplicates(table(spark, sf, "documents"), shingle_words=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op2_bpe(spark, sf: str) -> DataFrame:
    return encode_documents(table(spark, sf, "documents"))


@query
def op3_quality_rules(spark, sf: str) -> DataFrame:
    return quality_rules(table(spark, sf, "documents"), trusted_documents(spark, sf))


@query
def op10_decontaminate(spark, sf: str) -> DataFrame:
    found = decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.drop("clean_text")


@query
def op4_personal_data(spark, sf: str) -> DataFrame:
    return personal_data(table(spark, sf, "documents")).drop("span_list")


def encode_documents(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_round_trip(docs, path, public_tokenizers.PATTERN)


#: Names of sites whose pages are listed.
LISTED_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def listed_pages(spark, sf: str) -> DataFrame:
    """URLs of all pages of the listed sites."""
    pages = table(spark, sf, "pages").select("url")
    return pages.filter(F.col("url").rlike(r"://(?:[^/?#]*\.)?(?:" + "|".join(LISTED_SITES) + r")\.[^/?#]*"))


@query
def op5_records(spark, sf: str) -> DataFrame:
    return record_round_trip(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_sharding(spark, sf: str) -> DataFrame:
    return hilbert_shards(table(spark, sf, "documents"))


@query
def op7_url_filter(spark, sf: str) -> DataFrame:
    judged = filter_urls(table(spark, sf, "pages"), listed_pages(spark, sf))
    return judged.drop("listed")


@query
def op8_quality_classifier(spark, sf: str) -> DataFrame:
    doc_id = F.col("doc_id")
    calibrate = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1
    return quality_scores(
        table(spark, sf, "documents"), table(spark, sf, "labels"), calibrate, held_out(doc_id))


@query
def op9_secrets(spark, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return find_secrets(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)


@query
def op11_alignment(spark, sf: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_documents(table(spark, sf, "documents"), a, b)


def rebuilt_conversations(spark, sf: str) -> DataFrame:
    """Every conversation behind up to three turns of the one whose number it shares, in
    twenties; how many is told by the checksum of its number."""
    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string").cast("binary")) % 4
    return conversation_paths(table(spark, sf, "conversations"), conv - conv % 20, shared)


@query
def op12_prefix_trie(spark, sf: str) -> DataFrame:
    return prefix_trie(materialize(rebuilt_conversations(spark, sf), "rebuilt"))


#: What a conversation of marks says, to show that they come back as they went in.
MARKS = r"\### Assistant: </turn> ok"


@query
def op13_chat_format(spark, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], turns.schema)
    read = read_conversations(format_conversations(turns.unionByName(marks)))
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("messages").cast("long").alias("n_turns"), sha256_hex(said).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), sha256_hex(loss).alias("loss_sha256"), "formatted_chars")


_TURNS = f"""turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '{MARKS}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r))"""

# a run of three or more # gets as many backslashes as it is long, as does every other mark one
ORACLES["op13_chat_format"] = f"""WITH {_TURNS}, sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\\', ''))
    + len(regexp_extract_all(text, '</turn>'))
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x))), 0) AS text_chars,
    length(role) + length(role) - length(regexp_replace(role, '[\\#:]', '', 'g'))
    + len(regexp_extract_all(role, '</turn>')) AS role_chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(text_chars + role_chars + 14)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""

# the checksum of a number's digits, bit by bit: a byte is taken in, then eight steps
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    range(1, length(conv_id::VARCHAR) + 1), lambda i: [ascii(substring(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295::BIGINT)"""

ORACLES["op12_prefix_trie"] = f"""WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
given AS (SELECT conv_id, list(said ORDER BY n) AS said FROM turns GROUP BY conv_id),
heads AS (SELECT *, {_CRC32} % 4 AS h FROM given),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.said[1:c.h], []), c.said[c.h + 1:]) AS path
  FROM heads c LEFT JOIN given b ON b.conv_id = c.conv_id - c.conv_id % 20),
visits AS (SELECT conv_id, unnest(range(0, len(path) + 1)) AS depth, path FROM rebuilt),
keyed AS (SELECT conv_id, depth, path[1:depth] AS node, path[1:depth - 1] AS above, len(path) = depth AS ends FROM visits),
nodes AS (
  SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0
      ELSE len(regexp_extract_all(any_value(node[depth].text), '[^\x20\x09-\x0D]+')) END AS saved
  FROM keyed GROUP BY node, depth),
children AS (SELECT above, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above, depth),
linked AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.above = n.node AND c.depth = n.depth),
below AS (
  SELECT top, top_depth, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT node[1:d] AS top, d AS top_depth, saved, n_children
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM linked)) GROUP BY top, top_depth)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM linked n JOIN below b ON b.top = n.node AND b.top_depth = n.depth
LEFT JOIN nodes p ON p.node = n.above AND p.depth = n.depth - 1 AND n.depth > 0"""

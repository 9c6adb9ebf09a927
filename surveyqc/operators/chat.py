"""Chat records: the line format in which cases are handed on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqc.functions import json as J
from surveyqc.functions.codes import empty_codes, expected_codes
from surveyqc.operators.once import with_once
from surveyqc.operators.prepare import BASE_ID, CLEAN, CODES, ROW_IDS

SYSTEM_TEXT = "P0P"  # fixed value: placeholder of the system message
MESSAGES = "array<struct<role:string,content:string>>"


def build_chat(groups: DataFrame) -> DataFrame:
    """Groups as ``(id, messages)``; the assistant message holds both lists as JSON."""
    lists = F.to_json(F.struct(CODES, ROW_IDS))

    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return groups.select(
        F.col(BASE_ID).alias("id"),
        F.array(
            message("system", F.lit(SYSTEM_TEXT)),
            message("user", F.col(CLEAN)),
            message("assistant", lists),
        ).alias("messages"),
    )


def chat_lines(records: DataFrame) -> DataFrame:
    """Records as JSON lines in a column ``value``, ready for ``write.text``."""
    return records.select(F.to_json(F.struct("id", "messages")).alias("value"))


def read_chat(lines: DataFrame, min_messages: int = 3) -> DataFrame:
    """Records from JSON lines; bad lines and records with too few messages are left out."""
    v = J.strict_variant(F.col("value"))
    return (
        with_once(lines, __v=v)
        .filter(J.is_object(J.node(F.col("__v"))))
        .withColumn("messages", F.try_variant_get("__v", J.ROOT + ".messages", MESSAGES))
        .filter(F.size("messages") >= min_messages)
        .withColumn("id", J.text_of(F.col("__v"), J.ROOT + ".id"))
        .drop("__v", "value")
    )


def _with_lists(records: DataFrame) -> DataFrame:
    inner = J.strict_variant(F.get("messages", F.lit(2))["content"])
    return with_once(records, __lists=inner).withColumn(
        "__readable", J.is_object(J.node(F.col("__lists")))
    )


def _row_ids():
    found = F.try_variant_get("__lists", f"{J.ROOT}.{ROW_IDS}", "array<string>")
    return F.when(F.col("__readable"), F.coalesce(found, empty_codes())).otherwise(empty_codes())


def cases_from_chat(records: DataFrame) -> DataFrame:
    """Cases to classify; records whose inner lists are unreadable are left out."""
    extra = [c for c in records.columns if c not in ("id", "messages")]
    return (
        _with_lists(records)
        .filter("__readable")
        .select(
            "id",
            F.get("messages", F.lit(1))["content"].alias("observacion"),
            expected_codes(J.node(F.col("__lists"), f"{J.ROOT}.{CODES}")).alias("expected_codes"),
            _row_ids().alias(ROW_IDS),
            *extra,
        )
    )


def reference_from_chat(records: DataFrame) -> DataFrame:
    """``(id, row ids)`` for reconciling; unreadable inner lists count as no ids."""
    extra = [c for c in records.columns if c not in ("id", "messages")]
    return (
        _with_lists(records)
        .filter(F.coalesce(F.col("id"), F.lit("")) != "")
        .select("id", _row_ids().alias(ROW_IDS), *extra)
    )


def replace_user_text(records: DataFrame, clean) -> DataFrame:
    """Apply a column function to the user message of every record."""
    changed = F.transform(
        "messages",
        lambda m, i: F.when(
            i == 1, F.struct(m["role"].alias("role"), clean(m["content"]).alias("content"))
        ).otherwise(m),
    )
    return records.withColumn("messages", changed)

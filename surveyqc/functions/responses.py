"""Reading model responses that may be malformed or cut off.

All functions take the strict variant of :func:`surveyqc.functions.json.strict_variant`
next to the text, so that a caller parses each response once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyqc.functions import json as J
from surveyqc.functions.codes import empty_codes
from surveyqc.functions.text import WS

# Texts that later steps and reviewers look for
NO_REASONING = "No se encontró razonamiento."
PARTIAL_REASONING = "Razonamiento extraído parcialmente."
REGEX_REASONING = "Códigos extraídos con regex."
UNREADABLE = "Error de parseo - respuesta no válida: "
FAILED = "Error en procesamiento: "
TRUNCATED_MARK = " [TRUNCADO]"
FALLBACK_WORD = "fallback"

# What counts as a recognisable piece of a broken response
EMBEDDED_OBJECT = rf'(?sU)\{{.*?"clasificaciones":{WS}*\[.*?\]{WS}*\}}'
LOOSE_CODE = rf'(?U)"codigo":{WS}*"(\d+)"'
COMPLETE_BLOCK = (
    rf'(?sU)\{{{WS}*"codigo":{WS}*"(\d+)",{WS}*"justificacion":{WS}*"(.*?)"{WS}*\}}'
)
CUT_BLOCK = rf'(?sU)^\{{{WS}*"codigo":{WS}*"(\d+)",{WS}*"justificacion":{WS}*"(.*)'

DETAIL_MAP = "map<string,string>"
PARSED = "struct<codes:array<string>,reasoning:string,failed:boolean>"

_LIST = J.ROOT + ".clasificaciones"


def _code_name(v: Column) -> Column:
    """A code as printed: null and booleans as their Python names."""
    s = J.text_of(v)
    return (
        F.when(J.kind(v) == "VOID", F.lit("None"))
        .when(J.kind(v) == "BOOLEAN", F.initcap(s))
        .otherwise(s)
    )


def _listed_codes(v: Column) -> Column:
    """Sorted codes of the classification objects; repeated codes stay repeated."""
    items = F.coalesce(J.elements(v, _LIST), F.array().cast("array<variant>"))
    kept = F.filter(items, lambda x: J.is_object(x) & J.truthy(J.node(x, "$.codigo")))
    return F.array_sort(F.transform(kept, lambda x: _code_name(J.node(x, "$.codigo"))))


def _result(codes: Column, reasoning: Column, failed: bool = False) -> Column:
    return F.struct(
        codes.alias("codes"),
        reasoning.cast("string").alias("reasoning"),
        F.lit(failed).alias("failed"),
    )


def _from_object(v: Column, default_reasoning: str) -> Column:
    path = J.ROOT + ".razonamiento"
    reasoning = F.when(J.node(v, path).isNull(), F.lit(default_reasoning)).otherwise(
        J.text_of(v, path)
    )
    return _result(_listed_codes(v), reasoning)


def embedded_object(text: Column) -> Column:
    """The first span that looks like a whole payload inside other text, else ``''``."""
    return F.regexp_extract(text, EMBEDDED_OBJECT, 0)


def as_object(text: Column) -> Column:
    """Wrap a bare array of classifications into a payload."""
    return F.when(
        F.startswith(text, F.lit("[")), F.concat(F.lit('{"clasificaciones":'), text, F.lit("}"))
    ).otherwise(text)


def parse_response(text: Column, v: Column, embedded: Column) -> Column:
    """Codes and reasoning in three tiers: the whole text is a JSON payload; a payload
    is embedded in it; codes are found by pattern. ``failed`` marks valid JSON of a
    shape that is no payload. ``v`` and ``embedded`` are the strict variants of the
    trimmed text and of :func:`embedded_object`."""
    shape = J.kind(J.node(v, _LIST))
    not_a_list = F.coalesce(~shape.isin("ARRAY", "OBJECT", "STRING"), F.lit(False))
    loose = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(LOOSE_CODE), 1)))
    unreadable = F.concat(F.lit(UNREADABLE), F.substring(text, 1, 100), F.lit("..."))
    return (
        F.when(
            v.isNotNull() & ~J.is_object(J.node(v)),
            _result(empty_codes(), F.lit(FAILED + "la respuesta no es un objeto JSON"), True),
        )
        .when(
            v.isNotNull() & not_a_list,
            _result(empty_codes(), F.lit(FAILED + "clasificaciones no es una lista"), True),
        )
        .when(v.isNotNull(), _from_object(v, NO_REASONING))
        .when(embedded.isNotNull(), _from_object(embedded, PARTIAL_REASONING))
        .when(F.size(loose) > 0, _result(loose, F.lit(REGEX_REASONING)))
        .otherwise(_result(empty_codes(), unreadable))
    )


def _last_wins(entries: Column) -> Column:
    """Array of (k, v) to a map; of equal keys the last entry counts."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    values = F.transform(
        keys, lambda k: F.element_at(F.filter(entries, lambda e: e["k"] == k), -1)["v"]
    )
    return F.map_from_arrays(keys, values)


def detail_map(text: Column, v: Column) -> Column:
    """Code → justification. Valid payloads are read as JSON; anything else by pattern,
    with a cut-off last block marked as truncated."""
    entry = "array<struct<k:string,v:string>>"
    items = F.coalesce(J.elements(v, _LIST), F.array().cast("array<variant>"))
    full = F.filter(
        items,
        lambda x: J.is_object(x)
        & J.node(x, "$.codigo").isNotNull()
        & J.node(x, "$.justificacion").isNotNull(),
    )
    from_json = F.transform(
        full,
        lambda x: F.struct(
            _code_name(J.node(x, "$.codigo")).alias("k"),
            J.text_of(x, "$.justificacion").alias("v"),
        ),
    )

    blocks = F.zip_with(
        F.regexp_extract_all(text, F.lit(COMPLETE_BLOCK), 1),
        F.regexp_extract_all(text, F.lit(COMPLETE_BLOCK), 2),
        lambda k, j: F.struct(k.alias("k"), j.alias("v")),
    )
    tail = F.concat(F.lit("{"), F.substring_index(text, "{", -1))
    cut_code = F.regexp_extract(tail, CUT_BLOCK, 1)
    is_cut = (
        F.contains(text, F.lit("{"))
        & (cut_code != "")
        & ~F.array_contains(F.transform(blocks, lambda e: e["k"]), cut_code)
    )
    cut = F.array(
        F.struct(
            cut_code.alias("k"),
            F.concat(F.regexp_extract(tail, CUT_BLOCK, 2), F.lit(TRUNCATED_MARK)).alias("v"),
        )
    )
    by_pattern = F.when(is_cut, F.concat(blocks, cut)).otherwise(blocks)

    has_list = J.node(v, _LIST).isNotNull()
    return _last_wins(
        F.when(F.coalesce(text, F.lit("")) == "", F.array().cast(entry))
        .when(has_list, from_json.cast(entry))
        .otherwise(by_pattern.cast(entry))
    )


def format_class(reasoning: Column, v: Column) -> Column:
    """Response class ``A`` … ``E`` from: fallback mentioned, valid JSON, codes present."""
    fallback = F.contains(F.lower(F.coalesce(reasoning, F.lit(""))), F.lit(FALLBACK_WORD))
    valid = v.isNotNull()
    filled = valid & J.truthy(J.node(v, _LIST))
    return (
        F.when(~fallback & filled, "A")
        .when(fallback & filled, "B")
        .when(fallback & ~valid, "C")
        .when(~fallback, "D")
        .otherwise("E")
    )


def attempt_codes(v: Column) -> Column:
    """Codes of one attempt, sorted, a missing code as ``N/A``; null if unreadable."""
    items = F.coalesce(J.elements(v, _LIST), F.array().cast("array<variant>"))

    def name(x: Column) -> Column:
        code = J.node(x, "$.codigo")
        return F.when(code.isNull(), F.lit("N/A")).otherwise(_code_name(code))

    usable = J.is_object(J.node(v)) & F.forall(items, lambda x: J.is_object(x))
    return F.when(usable, F.array_sort(F.transform(items, name)))

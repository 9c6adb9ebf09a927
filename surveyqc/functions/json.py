"""Strict JSON on strings.

Spark's JSON readers accept trailing garbage and read cut-off text as far as it
goes, so validity is settled first. A text is one whole JSON value exactly if it
parses both as the only element of an array and as the only member of an object:
whatever could close one of the two wrappers early is a syntax error in the other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROOT = "$.v"


#: From so many bytes on a text may hold a string that the plain variant parser refuses.
LONG_BYTES = 20_000_000

#: For the JSON reader: strict JSON with strings of any length.
ANY_LENGTH = {
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

#: What a variant can hold at most; a longer text that is valid raises, it is never lost.
VARIANT_BYTES = 128 << 20


def _variant(text: Column) -> Column:
    """The text as a variant, null if it is no JSON. The plain parser has a limit on the
    length of a string, the reader has an option for it, so long texts take the reader."""
    return F.when(F.octet_length(text) < LONG_BYTES, F.try_parse_json(text)).otherwise(
        F.from_json(text, "variant", ANY_LENGTH)
    )


def strict_variant(text: Column) -> Column:
    """``{"v": <text>}`` as a variant, null unless ``text`` is one valid JSON value. Strings
    in it may have any length; a valid value that no variant can hold raises an error."""
    whole = F.concat(F.lit("["), text, F.lit("]"))
    named = F.concat(F.lit('{"v":'), text, F.lit("}"))
    in_array, in_object = _variant(whole), _variant(named)
    # the text functions of JSON have no such limit, so they tell too long from invalid
    too_long = (
        (F.octet_length(text) > VARIANT_BYTES // 2) & in_object.isNull()
        & (F.json_array_length(whole) == 1) & (F.size(F.json_object_keys(named)) == 1)
    )
    message = F.concat(
        F.lit("a JSON value of "), F.octet_length(text).cast("string"),
        F.lit(" bytes is more than a variant holds"),
    )
    return F.when(too_long, F.raise_error(message).cast("variant")).when(in_array.isNotNull(), in_object)


def node(v: Column, path: str = ROOT) -> Column:
    """The variant at ``path``: SQL null if absent, a variant null if it is JSON null."""
    return F.try_variant_get(v, path, "variant")


def kind(v: Column) -> Column:
    """``OBJECT``, ``ARRAY``, ``STRING``, ``BIGINT``, ``DECIMAL``, ``DOUBLE``,
    ``BOOLEAN`` or ``VOID``; null if absent."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def text_of(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "string")


def elements(v: Column, path: str = "$") -> Column:
    """Array elements as variants, null if there is no array at ``path``."""
    return F.try_variant_get(v, path, "array<variant>")


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v) == "OBJECT", F.lit(False))


def truthy(v: Column) -> Column:
    """False for absent, null, empty text, zero, false and empty containers."""
    k = kind(v)
    s = text_of(v)
    return F.coalesce(
        F.when(k == "VOID", F.lit(False))
        .when(k == "STRING", s != "")
        .when(k == "BOOLEAN", s == "true")
        .when(k == "ARRAY", s != "[]")
        .when(k == "OBJECT", s != "{}")
        .when(k.isNotNull(), s.try_cast("double") != 0),
        F.lit(False),
    )

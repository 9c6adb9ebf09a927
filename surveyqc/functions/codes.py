"""Expected and predicted category codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyqc.functions import json as J
from surveyqc.functions.text import strip_ws

NO_CODES = "array<string>"


def _tidy(codes: Column) -> Column:
    kept = F.filter(codes, lambda c: c.isNotNull() & (c != ""))
    return F.array_sort(F.array_distinct(kept))


def empty_codes() -> Column:
    return F.array().cast(NO_CODES)


def sorted_codes(codes: Column) -> Column:
    """Trimmed, non-empty, distinct and sorted; null gives no codes."""
    return _tidy(F.transform(F.coalesce(codes, empty_codes()), lambda c: strip_ws(c)))


def expected_codes(v: Column) -> Column:
    """Normalise a JSON value that stands for a list of codes.

    One string counts as a list of one, any other non-list as no codes. Inside the
    list numbers are truncated, texts trimmed, ``{"codigo": …}`` gives its code, the
    rest is dropped; the result is distinct and sorted as text.
    """
    items = (
        F.when(J.kind(v) == "STRING", F.array(v))
        .when(J.kind(v) == "ARRAY", J.elements(v))
        .otherwise(F.array().cast("array<variant>"))
    )

    def one(x: Column) -> Column:
        k = J.kind(x)
        number = F.try_variant_get(x, "$", "double").try_cast("bigint").cast("string")
        return (
            F.when(k == "STRING", strip_ws(J.text_of(x)))
            .when(k == "BIGINT", J.text_of(x))
            .when(k.isin("DECIMAL", "DOUBLE", "FLOAT"), number)
            .when(k == "BOOLEAN", F.when(J.text_of(x) == "true", "1").otherwise("0"))
            .when(k == "OBJECT", strip_ws(J.text_of(x, "$.codigo")))
        )

    return _tidy(F.transform(items, one))


def false_positives(expected: Column, predicted: Column) -> Column:
    return F.array_sort(F.array_except(predicted, expected))


def false_negatives(expected: Column, predicted: Column) -> Column:
    return F.array_sort(F.array_except(expected, predicted))

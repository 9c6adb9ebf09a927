"""Unify response records, compare them with the reference cases, unnest to rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from surveyqc.functions import json as J
from surveyqc.functions import responses as R
from surveyqc.functions.codes import empty_codes
from surveyqc.operators.once import with_once
from surveyqc.operators.prepare import BASE_ID, OBS_KEY, ROW_ID, ROW_IDS, with_texts
from surveyqc.operators.skew import salted_join
from surveyqc.sources.files import with_line_numbers

# Fields under which foreign files may carry the id, in order
ID_FIELDS = ("id", "case_id", "id_observacion")

RECORD = (
    "observacion string, expected_codes array<string>, ids_delito_originales array<string>, "
    "predicted_codes array<string>, razonamiento_modelo string, raw_response string, "
    "timestamp string, error boolean"
)

READING_ERROR = "Error de Lectura"  # fixed value: class of unreadable lines
OK, BAD_JSON, NO_ID, OTHER = "ok", "bad_json", "no_id", "other_error"


def load_records(lines: DataFrame) -> DataFrame:
    """Judge JSON lines: adds ``status`` and ``id``; keeps the line and its order columns.

    The first id field that is *present* counts, even if it is null.
    """
    v = F.col("__v")
    root = J.node(v)
    fields = [J.node(v, f"{J.ROOT}.{name}") for name in ID_FIELDS]
    found = F.coalesce(*fields)
    shape = J.kind(root)
    touches_id = F.contains(J.text_of(root), F.lit("id"))
    status = (
        F.when(v.isNull(), BAD_JSON)
        .when(shape == "OBJECT", F.when(J.truthy(found), OK).otherwise(NO_ID))
        .when(shape == "ARRAY", NO_ID)
        .when((shape == "STRING") & ~touches_id, NO_ID)
        .otherwise(OTHER)
    )
    judged = with_once(with_once(lines, __v=J.strict_variant(F.col("value"))), status=status)
    return judged.withColumn("id", F.when(F.col("status") == OK, J.text_of(found))).drop("__v")


def load_audit(loaded: DataFrame) -> DataFrame:
    return loaded.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def unreadable_lines(loaded: DataFrame, width: int = 100) -> DataFrame:
    """Start of every line that is no JSON, with its place."""
    order = [c for c in loaded.columns if c not in ("value", "status", "id")]
    return loaded.filter(F.col("status") == BAD_JSON).select(
        *order, F.substring("value", 1, width).alias("contenido_parcial")
    )


def _json_error(line: Column) -> Column:
    """What a strict parser says of a line and the place it stopped at."""

    @F.pandas_udf(StringType())
    def said(lines: pd.Series) -> pd.Series:
        import json

        def one(text: str) -> str:
            try:
                json.loads(text + "\n")
            except ValueError as e:
                return str(e)
            except RecursionError:
                return "nested too deeply"
            return "repeated key, or a number that JSON does not have"

        return lines.map(one)

    return said(line)


def reading_errors(loaded: DataFrame, lines: DataFrame, width: int = 100) -> DataFrame:
    """Every line that is no JSON, as a class of its own next to the response classes: file,
    ``linea`` (its number), ``error`` (message and position, at most ``width`` characters)
    and the start of the line. Only such lines go to Python, for the message. ``lines`` are
    the rows of :func:`surveyqc.sources.files.read_lines` that ``loaded`` was made of."""
    bad = with_line_numbers(loaded.filter(F.col("status") == BAD_JSON), lines)
    return bad.select(
        "file", "linea", F.substring(_json_error(F.col("value")), 1, width).alias("error"),
        F.substring("value", 1, width).alias("contenido_parcial"),
        F.lit(READING_ERROR).alias("format_name"),
    )


def records_of(loaded: DataFrame) -> DataFrame:
    """Fields of the readable records that have an id."""
    order = [c for c in loaded.columns if c not in ("value", "status", "id")]
    return (
        with_once(loaded.filter(F.col("status") == OK), __r=F.from_json("value", RECORD, J.ANY_LENGTH))
        .select("id", "__r.*", *order)
    )


def last_wins(df: DataFrame, keys: list[str], order: list[str], place: list[str] | None = None) -> DataFrame:
    """Of equal keys the row that comes last in ``order``. Each task first keeps one row
    per key, so a repeated id is no burden however often it occurs.

    ``place`` names narrow columns that tell rows apart, such as file and position. With it
    only keys, order and place are aggregated; the wide rows are shuffled once, by key and
    place, to meet the winners, so those of one key go to many tasks.
    """
    if place is None:
        rest = [c for c in df.columns if c not in keys]
        picked = df.groupBy(*keys).agg(
            F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
        )
        return picked.select(*keys, "__row.*")
    last = df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in place if c not in order])).alias("__last"))
    last = last.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(f"__last.{c}").alias(f"__{c}") for c in place])
    same = [df[c].eqNullSafe(last[f"__{c}"]) for c in dict.fromkeys([*keys, *place])]
    return df.join(last, same, "left_semi")


def missing_ids(reference: DataFrame, unified: DataFrame) -> DataFrame:
    """Ids of the first table that the second lacks."""
    return reference.select("id").distinct().join(unified.select("id").distinct(), "id", "left_anti")


def smallest(ids: DataFrame, n: int = 5) -> DataFrame:
    """The report's examples: the n smallest ids."""
    return ids.orderBy("id").limit(n)


def with_details(records: DataFrame) -> DataFrame:
    """Add ``details``: code → justification as read from the raw response."""
    raw = F.coalesce(F.col("raw_response"), F.lit(""))
    return (
        with_once(records, __v=J.strict_variant(raw))
        .transform(lambda d: with_once(d, details=R.detail_map(raw, F.col("__v"))))
        .drop("__v")
    )


def listed_and_parsed() -> tuple[Column, Column]:
    """Codes of a record's list and codes of its detail map, both sorted."""
    listed = F.array_sort(F.array_distinct(F.coalesce("predicted_codes", empty_codes())))
    return listed, F.array_sort(F.map_keys("details"))


def parse_issues(detailed: DataFrame) -> DataFrame:
    """Records whose code list and detail map name different codes."""
    listed, parsed = listed_and_parsed()
    return detailed.select(
        "id", listed.alias("codes_list"), parsed.alias("codes_parsed")
    ).filter(F.col("codes_list") != F.col("codes_parsed"))


def _unnested(row_id: Column) -> list[Column]:
    return [
        row_id.alias("id_delito_ia"),
        F.col("id").alias("id_observacion"),
        F.col("observacion"),
        F.coalesce("expected_codes", empty_codes()).alias("expected_codes_obs"),
        F.coalesce("predicted_codes", empty_codes()).alias("predicted_codes_obs"),
        F.col("razonamiento_modelo").alias("razonamiento_general_modelo"),
        F.col("details").alias("predicciones_detalladas_modelo"),
        F.col("timestamp"),
        F.coalesce("error", F.lit(False)).alias("processing_error"),
    ]


def _with_observation(df: DataFrame, texts: DataFrame | None) -> DataFrame:
    """Narratives of :func:`surveyqc.operators.prepare.narratives` by ``text_key``, or the
    texts of a run, which have a column ``observacion``, by ``obs_key``."""
    if texts is None:
        return df
    if "observacion" in texts.columns:
        return with_texts(df, texts, "observacion", "observacion", OBS_KEY)
    return with_texts(df, texts, "observacion")


def unnest(detailed: DataFrame, reference: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One row per original row id of the reference record; a record without ids gives
    one row with a null id, a result without reference record gives none. Records that
    carry a ``text_key`` instead of their narrative get it from ``texts`` when all joins
    by id are done."""
    ids = reference.select("id", F.col(ROW_IDS).alias("__ids"))
    joined = _with_observation(detailed.join(ids, "id", "inner"), texts)
    exploded = joined.select("*", F.explode_outer("__ids").alias("__row_id"))
    return exploded.select(*_unnested(F.col("__row_id")))


def unnest_members(
    detailed: DataFrame, members: DataFrame, min_rows: int = 1_000_000, at_least: int = 0,
    texts: DataFrame | None = None,
) -> DataFrame:
    """As :func:`unnest` for row ids kept as rows (``ID_BASE, obs_key, ID_DELITO_IA``).
    The members of a hot group are spread over many tasks; fewer than ``at_least`` hot
    groups raise an error."""
    rows = members.withColumnRenamed(BASE_ID, "id")
    joined = salted_join(rows, detailed, ["id", OBS_KEY], "inner", min_rows=min_rows, at_least=at_least)
    return _with_observation(joined, texts).select(*_unnested(F.col(ROW_ID)))


def unnest_simple(detailed: DataFrame, reference: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One row per result that has a reference record; the row id is the case id."""
    known = detailed.join(reference.select("id").distinct(), "id", "left_semi")
    return _with_observation(known, texts).select(*_unnested(F.col("id")))


def drop_null_observations(unnested: DataFrame) -> DataFrame:
    return unnested.na.drop(subset=["id_observacion"])


def recon_summary(
    unified: DataFrame, reference: DataFrame, unnested: DataFrame, issues: DataFrame
) -> DataFrame:
    """Row counts of the stage in one row."""

    def n(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return unified.agg(F.count(F.lit(1)).alias("unified_records")).select(
        "unified_records",
        n(reference).alias("reference_records"),
        F.col("unified_records").alias("nested_count"),
        n(unnested).alias("unnested_count"),
        n(issues).alias("parsing_issues_count"),
    )

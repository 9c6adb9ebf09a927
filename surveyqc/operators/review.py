"""Review table: expected against predicted codes, row by row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqc.functions import codes as C
from surveyqc.functions import keys as K
from surveyqc.functions.reasoning import clean_reasoning

# Texts and codes of the review table
AMBIGUOUS_CODE = "30"
NO_JUSTIFICATION = "TRUNCADA/NO DISPONIBLE"
NO_JUSTIFICATION_OF_MATCH = "Justificación TRUNCADA/NO DISPONIBLE"
PART_SEPARATOR = "\n---\n"
NOTHING_PREDICTED = "Ninguno"
CORRECT, WRONG_CODE, UNCLEAR, NOT_REVIEWED, NOTHING_FOUND = 1, 2, 3, 4, 5

COMPLEX_COLUMNS = [
    "ID_DELITO_IA", "MATCH_DELITO", "ESTADO_REVISION", "OBSERVACION", "DELITO_ESPERADO",
    "JUSTIFICACION_ACIERTO", "DETALLE_ERRORES_MODELO", "RAZONAMIENTO_GENERAL",
]
SIMPLE_COLUMNS = ["ID_DELITO_IA", "OBSERVACION", "CODIGOS_PREDICHOS", "RAZONAMIENTO_GENERAL"]


def matched(code: Column, predicted: Column) -> Column:
    hit = (code != "") & F.array_contains(predicted, code)
    return F.coalesce(hit, F.lit(False))


def review_state(match: Column, predicted: Column) -> Column:
    return (
        F.when(match, CORRECT)
        .when(F.array_contains(predicted, AMBIGUOUS_CODE), UNCLEAR)
        .when(F.size(predicted) > 0, WRONG_CODE)
        .otherwise(NOTHING_FOUND)
    )


def false_positive_text(false_positives: Column, details: Column) -> Column:
    """One line per false positive with its justification; null if there is none."""

    def line(code: Column) -> Column:
        known = F.map_contains_key(details, code)
        why = F.when(known, F.coalesce(F.element_at(details, code), F.lit("None")))
        return F.concat(
            F.lit("Código FP: "), code,
            F.lit(" | Justificación: "), F.coalesce(why, F.lit(NO_JUSTIFICATION)),
        )

    text = F.array_join(F.transform(F.array_sort(false_positives), line), "\n")
    return F.when(F.size(false_positives) > 0, text)


def match_justification(match: Column, code: Column, details: Column) -> Column:
    known = F.map_contains_key(details, code)
    found = F.when(known, F.element_at(details, code))
    return F.when(match, F.when(known, found).otherwise(F.lit(NO_JUSTIFICATION_OF_MATCH)))


def error_detail(
    match: Column, code: Column, predicted: Column, fp: Column, fn: Column, fp_text: Column
) -> Column:
    printed = F.coalesce(code, F.lit("None"))
    missed = F.concat(F.lit("FN: El código esperado '"), printed, F.lit("' no fue detectado."))
    nothing = F.concat(
        F.lit("ERROR: El modelo no detectó ningún delito. Se esperaba el código '"),
        code,
        F.lit("' Revisar justificación."),
    )
    return (
        F.when((F.size(predicted) == 0) & (code != ""), nothing)
        .when(match, F.when((F.size(fp) > 0) & (F.size(fn) == 0), fp_text))
        .otherwise(F.concat_ws(PART_SEPARATOR, fp_text, missed))
    )


def review_complex(unnested: DataFrame) -> DataFrame:
    """State, match and explanations for every unnested row.

    All rows of an observation carry the same sets and details, so nothing has to be
    grouped: each row is judged where it is.
    """
    expected, predicted = F.col("expected_codes_obs"), F.col("predicted_codes_obs")
    details = F.col("predicciones_detalladas_modelo")
    match, code = F.col("MATCH_DELITO"), F.col("DELITO_ESPERADO")
    fp, fn = F.col("__fp"), F.col("__fn")
    reviewed = (
        unnested.filter(F.col("id_observacion").isNotNull())
        .withColumn("DELITO_ESPERADO", K.last_part(F.col("id_delito_ia")))
        .withColumn("MATCH_DELITO", matched(code, predicted))
        .withColumn("__fp", C.false_positives(expected, predicted))
        .withColumn("__fn", C.false_negatives(expected, predicted))
        .withColumn("__fp_text", false_positive_text(fp, details))
    )
    columns = {
        "ID_DELITO_IA": F.col("id_delito_ia"),
        "MATCH_DELITO": match,
        "ESTADO_REVISION": review_state(match, predicted),
        "OBSERVACION": F.col("observacion"),
        "DELITO_ESPERADO": code,
        "JUSTIFICACION_ACIERTO": match_justification(match, code, details),
        "DETALLE_ERRORES_MODELO": error_detail(
            match, code, predicted, fp, fn, F.col("__fp_text")
        ),
        "RAZONAMIENTO_GENERAL": clean_reasoning(F.col("razonamiento_general_modelo")),
    }
    return reviewed.select(*[columns[c].alias(c) for c in COMPLEX_COLUMNS])


def review_simple(unnested: DataFrame) -> DataFrame:
    codes = F.array_join("predicted_codes_obs", ", ")
    columns = {
        "ID_DELITO_IA": F.col("id_delito_ia"),
        "OBSERVACION": F.col("observacion"),
        "CODIGOS_PREDICHOS": F.when(codes == "", F.lit(NOTHING_PREDICTED)).otherwise(codes),
        "RAZONAMIENTO_GENERAL": clean_reasoning(F.col("razonamiento_general_modelo")),
    }
    kept = unnested.filter(F.col("id_observacion").isNotNull())
    return kept.select(*[columns[c].alias(c) for c in SIMPLE_COLUMNS])


def review_stats(review: DataFrame) -> DataFrame:
    """Rows, matches, match rate in percent, false negatives. A simple review has no
    matches to count."""
    n = F.count(F.lit(1))
    if "MATCH_DELITO" not in review.columns:
        none = F.lit(None)
        return review.agg(
            n.alias("total_records"),
            none.cast("bigint").alias("matches"),
            none.cast("double").alias("match_rate"),
            none.cast("bigint").alias("false_negatives"),
        )
    hits = F.count_if("MATCH_DELITO")
    return review.agg(
        n.alias("total_records"),
        hits.alias("matches"),
        F.when(n > 0, hits / n * 100).otherwise(0.0).alias("match_rate"),
        (n - hits).alias("false_negatives"),
    )

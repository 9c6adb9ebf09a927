"""From the raw survey table to cleaned, gated and grouped narratives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqc.functions import keys as K
from surveyqc.functions import text as T
from surveyqc.functions.codes import empty_codes
from surveyqc.operators.once import with_once
from surveyqc.options import COMPLEX, SurveyOptions, check_columns

ROW_ID = "ID_DELITO_IA"
BASE_ID = "ID_BASE"
CLEAN = "observacion_limpia"
CODES = "codigos_delito"
ROW_IDS = "ids_delito_originales"
OBS_KEY = "obs_key"
PASSED = "valida"
#: Digest of an uncleaned text, and a number that sorts cleaned texts.
TEXT_KEY, TEXT_ORDER = "text_key", "text_order"
#: Characters of a text that decide which range it falls into.
HEAD_CHARS = 64


def with_keys(df: DataFrame, options: SurveyOptions) -> DataFrame:
    """Add the row key and the base key; in simple mode both are the id itself. The id
    columns stay as they are."""
    check_columns(df, options.required_columns)
    if options.mode == COMPLEX:
        row_id = K.row_key(df, options.id_components, options.on_fractional)
        keyed = with_once(df, **{ROW_ID: row_id})
        return keyed.withColumn(BASE_ID, K.base_key(F.col(ROW_ID)))
    same = K.id_text(F.col(options.id_col), df.schema[options.id_col].dataType)
    return df.withColumn(ROW_ID, same).withColumn(BASE_ID, same)


def with_clean_text(df: DataFrame, options: SurveyOptions) -> DataFrame:
    return with_once(df, **{CLEAN: T.clean_text(F.col(options.text_col))})


def text_key(c) -> Column:
    """Digest of a text, 32 bytes; null counts as the empty text."""
    digest = F.unhex(F.sha2(T.as_text(c), 256))
    return F.coalesce(digest, F.lit(b""))  # never null: no filter on it follows from a join


def narratives(df: DataFrame, options: SurveyOptions) -> DataFrame:
    """The distinct texts of a survey by their digest, each cleaned once: ``text_key``, the
    text, the cleaned text and its key. Equal texts are combined before they are shuffled."""
    return with_obs_key(with_clean_text(distinct_texts(df, options.text_col), options))


def distinct_texts(df: DataFrame, text_col: str) -> DataFrame:
    """The distinct texts of a column, null as the empty text, with their digest."""
    raw = T.as_text(F.col(text_col)).alias(text_col)
    return df.select(raw).withColumn(TEXT_KEY, text_key(F.col(text_col))).distinct()


def dealt_by_key(texts: DataFrame) -> DataFrame:
    """Cleaned texts dealt by ``text_key``, with their key. All that is made of them in one
    job, such as their order and the join that puts them back, shares that shuffle, so a text
    is cleaned and moved there once; the digest of the cleaned text is taken after it, as
    shuffles of unlike columns are not shared."""
    return with_obs_key(texts.select(TEXT_KEY, CLEAN).repartition(TEXT_KEY))


def with_text_order(texts: DataFrame) -> DataFrame:
    """Add a number that sorts narratives as their cleaned texts do, so that later steps
    compare numbers and leave the texts where they are. Numbers of two evaluations need not
    agree: they are to be compared, never joined on."""
    return (
        texts.repartitionByRange(F.substring(CLEAN, 1, HEAD_CHARS))
        .sortWithinPartitions(CLEAN)
        .withColumn(TEXT_ORDER, F.monotonically_increasing_id())
    )


def with_narratives(df: DataFrame, texts: DataFrame, options: SurveyOptions) -> DataFrame:
    """Rows with the keys of their narratives in place of the text; rows whose text is not
    among ``texts`` are left out. Only keys are shuffled."""
    keyed = df.withColumn(TEXT_KEY, text_key(F.col(options.text_col))).drop(options.text_col)
    return keyed.join(texts.select(TEXT_KEY, OBS_KEY, *[c for c in [TEXT_ORDER] if c in texts.columns]), TEXT_KEY)


def with_texts(
    df: DataFrame, texts: DataFrame, name: str = CLEAN, text_col: str = CLEAN, key: str = TEXT_KEY
) -> DataFrame:
    """Give rows with a ``text_key`` (or another ``key``) their text again, as the last step
    of a job. One row per key is all that the join can add, so Spark drops it where the text
    is not used."""
    one = texts.groupBy(key).agg(F.any_value(text_col).alias(name))
    return df.join(one, key, "left")


def _code(df: DataFrame, options: SurveyOptions):
    return K.code_text(F.col(options.code_col), df.schema[options.code_col].dataType)


def _gate(options: SurveyOptions):
    return T.passes_gate(F.col(CLEAN), options.min_chars, options.min_words)


#: Whether a row had no text at all; its digest is that of the empty text.
NO_TEXT = "sin_texto"


def prepared_texts(df: DataFrame, options: SurveyOptions) -> DataFrame:
    """:func:`narratives` with their gate outcome, to be written once."""
    return with_once(narratives(df, options), **{PASSED: _gate(options)})


def prepared_rows(df: DataFrame, texts: DataFrame, options: SurveyOptions) -> DataFrame:
    """What later steps need of each raw row, to be written once: keys, code, the keys of the
    text and its gate outcome. Texts stay in ``texts``."""
    code = [options.code_col] if options.code_col else []
    raw = F.col(options.text_col)
    keyed = with_keys(df, options).select(
        ROW_ID, BASE_ID, *code, text_key(raw).alias(TEXT_KEY), raw.isNull().alias(NO_TEXT))
    return keyed.join(texts.select(TEXT_KEY, OBS_KEY, PASSED), TEXT_KEY)


def rejected_texts(rows: DataFrame, texts: DataFrame, options: SurveyOptions) -> DataFrame:
    """:func:`rejected_rows` of prepared rows and texts."""
    found = rows.filter(~F.col(PASSED)).drop(PASSED, OBS_KEY).join(texts.filter(~F.col(PASSED)), TEXT_KEY)
    return rejected_rows(
        found.withColumn(options.text_col, F.when(~F.col(NO_TEXT), F.col(options.text_col))), options)


def valid_rows(df: DataFrame, options: SurveyOptions) -> DataFrame:
    return df.filter(_gate(options))


def rejected_rows(df: DataFrame, options: SurveyOptions) -> DataFrame:
    """Rows below the quality gate with their original and their cleaned text."""
    return df.filter(~_gate(options)).select(
        F.col(ROW_ID).alias("id_delito_ia"),
        F.col(options.text_col).alias("observacion_original"),
        F.col(CLEAN),
    )


def group_observations(valid: DataFrame, options: SurveyOptions) -> DataFrame:
    """One row per base key and narrative with the sorted distinct codes and row ids.

    Sets are combined on the map side, so repeated rows never travel. A set holds at
    most one entry per distinct last id part, i.e. per category, not per row; where
    the last part is no category use :func:`group_codes` and :func:`group_members`.
    Rows of :func:`with_narratives` are grouped by the narrative's key, which travels in
    place of the text and is what :func:`with_texts` goes by.
    """
    if options.mode != COMPLEX:
        return simple_records(valid, options)
    return _grouped(valid, _code_set(valid, options), F.array_sort(F.collect_set(ROW_ID)).alias(ROW_IDS))


def _code_set(valid: DataFrame, options: SurveyOptions) -> Column:
    return F.array_sort(F.collect_set(_code(valid, options))).alias(CODES)


def _grouped(valid: DataFrame, *sets: Column) -> DataFrame:
    if CLEAN in valid.columns:
        return valid.groupBy(BASE_ID, CLEAN).agg(*sets)
    # texts that differ may be equal once cleaned: any of them stands for the group
    kept = [F.max(c).alias(c) for c in (TEXT_KEY, TEXT_ORDER) if c in valid.columns]
    return valid.groupBy(BASE_ID, OBS_KEY).agg(*sets, *kept)


def simple_records(valid: DataFrame, options: SurveyOptions) -> DataFrame:
    """One record per row: at most one code, the id as only row id."""
    codes = empty_codes()
    if options.code_col is not None:
        code = _code(valid, options)
        codes = F.when(code.isNull(), empty_codes()).otherwise(F.array(code))
    narrative = [c for c in (CLEAN, OBS_KEY, TEXT_KEY) if c in valid.columns][:1 if CLEAN in valid.columns else None]
    return valid.select(
        BASE_ID, *narrative, codes.alias(CODES), F.array(F.col(ROW_ID)).alias(ROW_IDS)
    )


def with_obs_key(df: DataFrame) -> DataFrame:
    """Add a narrow key of the narrative, for joins that need not carry the text."""
    if OBS_KEY in df.columns:
        return df
    return df.withColumn(OBS_KEY, F.sha2(F.col(CLEAN), 256))


def group_codes(valid: DataFrame, options: SurveyOptions) -> DataFrame:
    """Groups with their codes only: the cases to classify."""
    if options.mode != COMPLEX:
        return simple_records(valid, options).drop(ROW_IDS)
    return _grouped(valid, _code_set(valid, options))


def group_members(valid: DataFrame) -> DataFrame:
    """Distinct row ids of each group as rows: no array however many there are, and
    no narrative in the shuffle. Rows of one group spread by row id."""
    return with_obs_key(valid).select(BASE_ID, OBS_KEY, ROW_ID).distinct()


def group_stats(valid: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows before and after grouping, the difference and the reduction in percent."""
    before = valid.agg(F.count(F.lit(1))).scalar()
    counted = groups.agg(F.count(F.lit(1)).alias("filas_despues")).select(
        before.alias("filas_antes"), "filas_despues"
    )
    lost = F.col("filas_antes") - F.col("filas_despues")
    return counted.select(
        "filas_antes",
        "filas_despues",
        lost.alias("reduccion"),
        F.when(F.col("filas_antes") > 0, lost / F.col("filas_antes") * 100).alias("reduccion_pct"),
    )


def inconsistent_keys(valid: DataFrame) -> DataFrame:
    """Base keys with more than one narrative. Two steps, first (key, narrative), then
    key, so that a hot key is already collapsed when it meets in one task."""
    pairs = with_obs_key(valid).select(BASE_ID, OBS_KEY).distinct()
    return (
        pairs.groupBy(BASE_ID)
        .agg(F.count(F.lit(1)).alias("n_observaciones"))
        .filter(F.col("n_observaciones") > 1)
    )


def group_example(valid: DataFrame, options: SurveyOptions) -> DataFrame:
    """All valid rows of the most frequent base key (ties: smallest key), if any key
    has more than one row; :func:`group_observations` of them shows what they become.
    Rows of :func:`with_narratives` keep the narrative's key in place of the text."""
    top = (
        valid.groupBy(BASE_ID)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1)
        .orderBy(F.desc("__n"), BASE_ID)
        .limit(1)
        .select(BASE_ID)
    )
    narrative = [CLEAN] if CLEAN in valid.columns else [TEXT_KEY]
    columns = [BASE_ID, ROW_ID, *([options.code_col] if options.code_col else []), *narrative]
    return valid.select(*columns).join(F.broadcast(top), BASE_ID, "left_semi")

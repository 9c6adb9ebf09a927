"""One query per operator: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from checks import inputs as I
from surveyqc.functions import codes as C
from surveyqc.functions import json as J
from surveyqc.functions import keys as K
from surveyqc.functions import responses as R
from surveyqc.functions import text as T
from surveyqc.functions.reasoning import clean_reasoning
from surveyqc.operators import (
    chat, consistency, durable, infer, merge, prefixes, prepare, prompts, reconcile, review, triage,
)
from surveyqc.operators.prepare import BASE_ID, CLEAN, CODES, OBS_KEY, ROW_ID, ROW_IDS, TEXT_KEY, TEXT_ORDER
from surveyqc.options import SurveyOptions, check_columns
from surveyqc.plans.full_run import run_review
from surveyqc.sources import files
from surveyqc.sources.scratch import materialize, shared_folder

QUERIES = {}

# the offline classifier travels to the executors with its code
cloudpickle.register_pickle_by_value(I)


def query(f):
    QUERIES[f.__name__] = f
    return f


def joined(c, sep: str = ","):
    return F.array_join(c, sep)


def as_text(m):
    """A code → justification map as one text, in key order."""
    entries = F.transform(
        F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("~")))
    )
    return F.array_join(F.array_sort(entries), "|")


def rounded(c):
    return F.round(c, 6)


# ---- sources, cleaning, gate -------------------------------------------------------


@query
def src_raw(spark, sf) -> DataFrame:
    df = I.table(spark, sf, "documents")
    check_columns(df, I.DOCUMENTS.required_columns)
    return df.select("doc_id", "text", "lang", "source")


@query
def text_clean(spark, sf) -> DataFrame:
    df = I.table(spark, sf, "documents")
    return df.select("doc_id", T.clean_text(F.col("text")).alias(CLEAN))


@query
def quality_gate(spark, sf) -> DataFrame:
    df = prepare.with_clean_text(I.table(spark, sf, "documents"), I.DOCUMENTS)
    passed = T.passes_gate(F.col(CLEAN), I.DOCUMENTS.min_chars, I.DOCUMENTS.min_words)
    return (
        df.select("lang", passed.alias("valid"), F.length(CLEAN).alias("n"))
        .groupBy("lang", "valid")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("chars"))
    )


@query
def quality_rejects(spark, sf) -> DataFrame:
    return prepare.rejected_rows(I.cleaned(spark, sf), I.OPTIONS)


@query
def key_build(spark, sf) -> DataFrame:
    line = I.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("HOGAR"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber").cast("string"))
        .otherwise("sin dato").alias("P201"),
        F.col("l_suppkey").cast("double").alias("ID"),
        F.when(F.col("l_quantity") < 50, F.col("l_quantity")).alias("P424_ID"),
        F.lit("").alias("OBS_400A"),
    )
    keyed = prepare.with_keys(line, I.OPTIONS)
    return keyed.select(
        "HOGAR", ROW_ID, BASE_ID, K.code_text(F.col("P424_ID"), DoubleType()).alias("code")
    )


@query
def key_simple(spark, sf) -> DataFrame:
    options = SurveyOptions.simple(id_col="doc_id", text_col="text", code_col="quality")
    df = I.table(spark, sf, "documents").join(
        I.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    df = prepare.with_clean_text(prepare.with_keys(df, options), options)
    groups = prepare.group_observations(prepare.valid_rows(df, options), options)
    return groups.select(
        BASE_ID, F.md5(CLEAN).alias("text_md5"), joined(CODES).alias("codes"),
        joined(ROW_IDS).alias("ids"),
    )


# ---- grouping ----------------------------------------------------------------------


@query
def group_obs(spark, sf) -> DataFrame:
    return I.groups(spark, sf).select(
        BASE_ID, F.md5(CLEAN).alias("text_md5"), joined(CODES).alias("codes"),
        joined(ROW_IDS).alias("ids"),
    )


@query
def group_members(spark, sf) -> DataFrame:
    return prepare.group_members(I.valid(spark, sf))


@query
def group_stats(spark, sf) -> DataFrame:
    valid = I.valid(spark, sf)
    stats = prepare.group_stats(valid, prepare.group_codes(valid, I.OPTIONS))
    return stats.withColumn("reduccion_pct", rounded("reduccion_pct"))


@query
def inconsistent_keys(spark, sf) -> DataFrame:
    return prepare.inconsistent_keys(I.valid(spark, sf))


@query
def group_example(spark, sf) -> DataFrame:
    rows = prepare.group_example(I.keyed_valid(spark, sf, ordered=False), I.OPTIONS)
    return prepare.with_texts(rows, I.narratives(spark, sf)).drop(TEXT_KEY)


@query
def group_example_after(spark, sf) -> DataFrame:
    rows = group_example(spark, sf)
    return prepare.group_observations(rows, I.OPTIONS).select(
        BASE_ID, joined(CODES).alias("codes"), joined(ROW_IDS).alias("ids"), CLEAN
    )


# ---- chat records ------------------------------------------------------------------


@query
def chat_build(spark, sf) -> DataFrame:
    m = F.col("messages")
    inner = F.from_json(m[2]["content"], f"{CODES} array<string>, {ROW_IDS} array<string>")
    return chat.build_chat(I.groups(spark, sf)).select(
        "id",
        joined(F.transform(m, lambda x: x["role"])).alias("roles"),
        m[0]["content"].alias("system"),
        F.md5(m[1]["content"]).alias("user_md5"),
        joined(inner[CODES]).alias("codes"),
        joined(inner[ROW_IDS]).alias("ids"),
    )


def _damaged_chat(spark, sf) -> DataFrame:
    """Chat lines of which some are cut off, short of a message or unreadable inside."""
    h = F.split("id", "-")[0].cast("bigint")
    records = chat.build_chat(I.groups(spark, sf)).withColumn("h", h)
    m = F.col("messages")
    bad = F.struct(m[2]["role"].alias("role"), F.lit('{"codigos_delito":["9"').alias("content"))
    m = (
        F.when(F.col("h") % 10 == 4, F.slice(m, 1, 2))
        .when(F.col("h") % 10 == 5, F.concat(F.slice(m, 1, 2), F.array(bad)))
        .otherwise(m)
    )
    line = F.col("value")
    cut = F.when(F.col("h") % 10 == 3, F.substr(line, F.lit(1), F.length(line) - 4))
    records = records.withColumn("messages", m)
    lines = records.select("h", F.to_json(F.struct("id", "messages")).alias("value"))
    return lines.select(F.coalesce(cut, line).alias("value"))


@query
def chat_read(spark, sf) -> DataFrame:
    records = chat.read_chat(_damaged_chat(spark, sf), 3)
    return chat.cases_from_chat(records).select(
        "id", F.md5("observacion").alias("user_md5"),
        joined("expected_codes").alias("codes"), joined(ROW_IDS).alias("ids"),
    )


@query
def chat_reference(spark, sf) -> DataFrame:
    records = chat.read_chat(_damaged_chat(spark, sf), 2)
    ids = chat.reference_from_chat(records)
    return ids.select("id", F.size(ROW_IDS).alias("n_ids"), joined(ROW_IDS).alias("ids"))


@query
def chat_clean(spark, sf) -> DataFrame:
    """Prefixes mined over the user messages and removed inside the records."""
    records = chat.build_chat(I.groups(spark, sf))
    texts = records.select(F.col("messages")[1]["content"].alias("text"))
    patterns = prefixes.collect_prefixes(prefixes.prefix_counts(texts, "text"), I.OPTIONS)
    cleaned = chat.replace_user_text(records, lambda c: prefixes.remove_prefixes(c, patterns))
    m = F.col("messages")
    return cleaned.select(
        "id", F.md5(m[1]["content"]).alias("user_md5"), m[0]["content"].alias("system"),
        F.size(m).alias("n_messages"),
    )


# ---- prefixes ----------------------------------------------------------------------


def _documents(spark, sf) -> DataFrame:
    return I.table(spark, sf, "documents").select("doc_id", "text")


@query
def prefix_ngrams(spark, sf) -> DataFrame:
    return prefixes.opening_phrases(_documents(spark, sf), "text").drop("text")


@query
def syllables(spark, sf) -> DataFrame:
    words = _documents(spark, sf).select(F.explode(F.split("text", r"[ \n]+")).alias("word"))
    return words.distinct().select("word", T.syllables(F.col("word")).alias("n"))


@query
def prefix_counts(spark, sf) -> DataFrame:
    counts = prefixes.prefix_counts(_documents(spark, sf), "text")
    return counts.withColumn("pct", rounded("pct"))


@query
def prefix_select(spark, sf) -> DataFrame:
    counts = prefixes.prefix_counts(_documents(spark, sf), "text")
    chosen = prefixes.selected_prefixes(counts, I.LOOSE)
    return chosen.withColumn("pct", rounded("pct"))


@query
def prefix_rank(spark, sf) -> DataFrame:
    counts = prefixes.prefix_counts(_documents(spark, sf), "text")
    ranked = prefixes.ranked_prefixes(counts, I.LOOSE)
    return ranked.withColumn("pct", rounded("pct"))


def _stripped(spark, sf):
    df = _documents(spark, sf)
    patterns = prefixes.collect_prefixes(prefixes.prefix_counts(df, "text"), I.LOOSE)
    return df.withColumn("clean", prefixes.remove_prefixes(F.col("text"), patterns)), patterns


@query
def pattern_clean(spark, sf) -> DataFrame:
    df, _ = _stripped(spark, sf)
    return df.select("doc_id", "clean")


@query
def pattern_stats(spark, sf) -> DataFrame:
    df, patterns = _stripped(spark, sf)
    stats = prefixes.removal_stats(df, "text", "clean", patterns)
    return stats.withColumn("cleaned_pct", rounded("cleaned_pct")).withColumn(
        "reduction_pct", rounded("reduction_pct")
    )


# ---- prompts and inference ---------------------------------------------------------


@query
def prompt_render(spark, sf) -> DataFrame:
    rendered = prompts.render_prompts(_documents(spark, sf), I.PROMPTS, "text")
    return rendered.select(
        "doc_id", F.length("system_prompt").alias("system_chars"), "user_prompt"
    )


@query
def prompt_stats(spark, sf) -> DataFrame:
    stats = prompts.prompt_stats(_documents(spark, sf), I.PROMPTS, "text")
    return stats.withColumn("avg_user_chars", rounded("avg_user_chars"))


@query
def batch_assign(spark, sf) -> DataFrame:
    """Cases with the key of their narrative in place of it; a narrative's digest is taken once."""
    cases = prepare.group_codes(I.keyed_valid(spark, sf), I.OPTIONS)
    batched = infer.assign_batches(cases, [BASE_ID, TEXT_ORDER], I.OPTIONS.batch_size)
    texts = I.narratives(spark, sf).select(TEXT_KEY, F.md5(CLEAN).alias("text_md5"))
    return prepare.with_texts(batched, texts, "text_md5", "text_md5").select(BASE_ID, "text_md5", "batch_id")


@query
def expected_norm(spark, sf) -> DataFrame:
    e, n = F.col("event_id"), F.col("event_id").cast("string")
    mixed = F.concat(
        F.lit("["), (e % 31).cast("string"), F.lit(', " '), F.col("user_id").cast("string"),
        F.lit(' ", '), F.col("value").cast("string"), F.lit(', null, "", {"codigo": '),
        (e % 7).cast("string"), F.lit('}, {"x": 1}, true]'),
    )
    text = (
        F.when(e % 10 == 0, F.concat(F.lit('" '), n, F.lit(' "')))
        .when(e % 10 == 1, F.lit('" "'))
        .when(e % 10 == 2, n)
        .when(e % 10 == 3, F.lit('{"codigo": 2}'))
        .otherwise(mixed)
    )
    events = I.table(spark, sf, "events").withColumn("v", J.strict_variant(text))
    codes = C.expected_codes(J.node(F.col("v")))
    return events.select("event_id", joined(codes).alias("codes"))


def _classified(spark, sf) -> DataFrame:
    cases = I.groups(spark, sf).select(
        F.col(BASE_ID).alias("id"),
        F.col(CLEAN).alias("observacion"),
        F.col(CODES).alias("expected_codes"),
        ROW_IDS,
    )
    return infer.to_records(infer.classify(cases, I.PROMPTS, I.length_model))


@query
def classify(spark, sf) -> DataFrame:
    return _classified(spark, sf).select(
        "id", F.md5("observacion").alias("text_md5"),
        joined("expected_codes").alias("expected"), joined("predicted_codes").alias("predicted"),
        "razonamiento_modelo", "raw_response", "error",
    )


@query
def classify_resumed(spark, sf) -> DataFrame:
    """Asked in waves of four batches by a run that stops after its first wave and is started
    again; ``n_answers`` are the answers of a case in the log."""
    log = durable.AnswerLog(f"{shared_folder(spark).rstrip('/')}/surveyqc/checks", uuid.uuid4().hex)
    cases = materialize(I.keyed_groups(spark, sf), "cases").select(
        F.col(BASE_ID).alias("id"), OBS_KEY, TEXT_KEY, F.col(CODES).alias("expected_codes"), ROW_IDS,
    )
    texts = materialize(I.narratives(spark, sf).select(TEXT_KEY, F.col(CLEAN).alias("observacion")), "texts")
    key = ["id", OBS_KEY]

    def run(**given) -> DataFrame:
        return durable.classify_in_waves(
            cases, I.PROMPTS, I.length_model, log, key, batch_size=I.OPTIONS.batch_size, wave_batches=4,
            texts=texts, text_key=TEXT_KEY, **given)

    run(max_waves=1)
    answered = infer.to_records(run())
    keyed = answered.withColumn("case_key", F.sha2(F.to_json(F.struct(*key)), 256))
    n = log.answers(spark).groupBy("case_key").agg(F.count(F.lit(1)).alias("n_answers"))
    whole = prepare.with_texts(keyed.join(n, "case_key"), texts, "observacion", "observacion")
    return whole.select(
        "id", F.md5("observacion").alias("text_md5"), joined("predicted_codes").alias("predicted"),
        "raw_response", "error", "n_answers",
    )


@query
def parse_response(spark, sf) -> DataFrame:
    return infer.parse_responses(I.answers(spark, sf)).select(
        "id", F.md5("observacion").alias("text_md5"),
        joined("parsed.codes").alias("codes"),
        F.col("parsed.reasoning").alias("reasoning"),
        F.col("parsed.failed").alias("failed"),
    )


@query
def case_totals(spark, sf) -> DataFrame:
    return infer.case_totals(I.groups(spark, sf))


@query
def batch_stats(spark, sf) -> DataFrame:
    batched = I.records(spark, sf).withColumn("batch_id", F.col("h") % 12 + 1)
    return infer.batch_stats(batched)


# ---- unify, reconcile, unnest ------------------------------------------------------


def _loaded(spark, sf) -> DataFrame:
    return reconcile.load_records(I.lines(spark, sf))


@query
def load_audit(spark, sf) -> DataFrame:
    return reconcile.load_audit(_loaded(spark, sf))


@query
def unreadable_lines(spark, sf) -> DataFrame:
    return reconcile.unreadable_lines(_loaded(spark, sf)).select(
        "file", F.md5("pos").alias("pos_md5"), "contenido_parcial"
    )


def _line_files(spark, sf) -> DataFrame:
    """The batch lines written to files, in the order of their text, and read back."""
    path = f"{shared_folder(spark).rstrip('/')}/surveyqc/lines-{uuid.uuid4().hex}"
    files.write_line_parts(I.lines(spark, sf), path)
    return files.read_lines(spark, f"{path}/*", parts=True)


@query
def reading_errors(spark, sf) -> DataFrame:
    lines = _line_files(spark, sf)
    errors = reconcile.reading_errors(reconcile.load_records(lines), lines)
    return errors.withColumn("file", F.regexp_extract("file", "/file=([^/]+)$", 1))


@query
def format_dist_lines(spark, sf) -> DataFrame:
    """Classes of the records of line files, unreadable lines among them."""
    lines = _line_files(spark, sf)
    loaded = reconcile.load_records(lines)
    classed = triage.with_format_class(reconcile.records_of(loaded))
    dist = triage.format_distribution(classed, reconcile.reading_errors(loaded, lines))
    return dist.withColumn("pct", rounded("pct"))


@query
def id_normalize(spark, sf) -> DataFrame:
    return _loaded(spark, sf).select("file", F.md5("pos").alias("pos_md5"), "status", "id")


@query
def batch_union(spark, sf) -> DataFrame:
    return reconcile.records_of(_loaded(spark, sf)).select(
        "id", "file", F.md5("observacion").alias("text_md5"), "razonamiento_modelo", "raw_response"
    )


def _unified_lines(spark, sf, *columns) -> DataFrame:
    """The last record per id; what is shown of a record is picked before rows are shuffled."""
    picked = reconcile.records_of(_loaded(spark, sf)).select("id", "file", TEXT_ORDER, *columns)
    return reconcile.last_wins(picked, ["id"], ["file", TEXT_ORDER])


@query
def dedup_last(spark, sf) -> DataFrame:
    text = F.md5("observacion").alias("text_md5")
    return _unified_lines(spark, sf, text, "razonamiento_modelo").drop(TEXT_ORDER)


@query
def recon_missing(spark, sf) -> DataFrame:
    return reconcile.missing_ids(I.reference(spark, sf), _unified_lines(spark, sf))


@query
def recon_extra(spark, sf) -> DataFrame:
    return reconcile.missing_ids(_unified_lines(spark, sf), I.reference(spark, sf))


@query
def recon_examples(spark, sf) -> DataFrame:
    return reconcile.smallest(recon_missing(spark, sf)).withColumn("side", F.lit("missing")).union(
        reconcile.smallest(recon_extra(spark, sf)).withColumn("side", F.lit("extra"))
    )


@query
def detail_map(spark, sf) -> DataFrame:
    detailed = reconcile.with_details(I.records(spark, sf))
    return detailed.select(
        "id", F.md5("observacion").alias("text_md5"), as_text(F.col("details")).alias("details")
    )


@query
def parse_issues(spark, sf) -> DataFrame:
    issues = reconcile.parse_issues(reconcile.with_details(I.unified(spark, sf)))
    return issues.select(
        "id", joined("codes_list").alias("codes_list"), joined("codes_parsed").alias("codes_parsed")
    )


def _shown(unnested) -> DataFrame:
    return unnested.select(
        "id_delito_ia", "id_observacion", F.md5("observacion").alias("text_md5"),
        joined("expected_codes_obs").alias("expected"),
        joined("predicted_codes_obs").alias("predicted"),
        "razonamiento_general_modelo",
        as_text(F.col("predicciones_detalladas_modelo")).alias("details"),
        "timestamp", "processing_error",
    )


@query
def unnest(spark, sf) -> DataFrame:
    return _shown(reconcile.drop_null_observations(I.unnested(spark, sf)))


@query
def unnest_members(spark, sf) -> DataFrame:
    """Row ids kept as rows, of a survey in which one group has a third of all; the query
    fails if no group is salted."""
    of = I.survey_hot_group
    detailed = reconcile.with_details(I.keyed_unified(spark, sf, of, (ROW_IDS,)))
    members = prepare.group_members(I.keyed_valid(spark, sf, of, ordered=False))
    unnested = reconcile.unnest_members(
        detailed, members, min_rows=2, at_least=1, texts=I.narratives(spark, sf, of))
    # the codes of the large group, as long as the group itself, are left out
    return _shown(unnested).drop("expected", "predicted")


@query
def unnest_simple(spark, sf) -> DataFrame:
    detailed = reconcile.with_details(I.keyed_unified(spark, sf, but=(ROW_IDS, OBS_KEY)))
    return _shown(reconcile.unnest_simple(detailed, I.reference(spark, sf), I.narratives(spark, sf)))


@query
def recon_summary(spark, sf) -> DataFrame:
    detailed = reconcile.with_details(I.keyed_unified(spark, sf))
    reference = I.reference(spark, sf)
    return reconcile.recon_summary(
        I.keyed_unified(spark, sf), reference, reconcile.unnest(detailed, reference, I.narratives(spark, sf)),
        reconcile.parse_issues(detailed),
    )


@query
def latest_run(spark, sf) -> DataFrame:
    """Records of two runs written side by side, and of one that never finished; the last
    finished one is read."""
    path = f"{shared_folder(spark).rstrip('/')}/surveyqc/runs-{uuid.uuid4().hex}"
    records = I.records(spark, sf).withColumn("batch_id", F.col("h") % 12 + 1)
    files.write_run(records.filter(F.col("h") % 2 == 0), path, "2025-01-01")
    files.write_run(records, path, "2025-01-02")
    records.limit(0).write.parquet(f"{path}/run_id=2025-01-03")
    return infer.batch_stats(files.read_latest_run(spark, path))


# ---- triage ------------------------------------------------------------------------


def _formats(spark, sf) -> DataFrame:
    return triage.with_format_class(I.unified(spark, sf))


@query
def format_class(spark, sf) -> DataFrame:
    return _formats(spark, sf).select("id", "format_class", "format_name")


@query
def format_dist(spark, sf) -> DataFrame:
    return triage.format_distribution(_formats(spark, sf)).withColumn("pct", rounded("pct"))


@query
def format_examples(spark, sf) -> DataFrame:
    return triage.format_examples(_formats(spark, sf))


@query
def problem_cases(spark, sf) -> DataFrame:
    return triage.problem_cases(_formats(spark, sf)).select("id", "format_class", "raw_response")


# ---- review ------------------------------------------------------------------------


@query
def row_code(spark, sf) -> DataFrame:
    return I.unnested(spark, sf).select(
        "id_delito_ia", K.last_part(F.col("id_delito_ia")).alias("code")
    )


@query
def code_sets(spark, sf) -> DataFrame:
    e, p = F.col("expected_codes_obs"), F.col("predicted_codes_obs")
    return I.unnested(spark, sf).select(
        "id_delito_ia",
        joined(C.false_positives(e, p)).alias("fp"),
        joined(C.false_negatives(e, p)).alias("fn"),
    )


@query
def fp_text(spark, sf) -> DataFrame:
    e, p = F.col("expected_codes_obs"), F.col("predicted_codes_obs")
    text = review.false_positive_text(
        C.false_positives(e, p), F.col("predicciones_detalladas_modelo")
    )
    return I.unnested(spark, sf).select("id_delito_ia", text.alias("fp_text"))


@query
def reasoning_clean(spark, sf) -> DataFrame:
    return I.answers(spark, sf).select(
        "id", F.md5("observacion").alias("text_md5"),
        clean_reasoning(F.col("razonamiento_modelo")).alias("reasoning"),
    )


def _review(spark, sf, of=I.survey) -> DataFrame:
    return review.review_complex(I.unnested(spark, sf, of))


@query
def review_state(spark, sf) -> DataFrame:
    return _review(spark, sf).select("ID_DELITO_IA", "MATCH_DELITO", "ESTADO_REVISION")


@query
def error_detail(spark, sf) -> DataFrame:
    return _review(spark, sf).select("ID_DELITO_IA", "DETALLE_ERRORES_MODELO")


@query
def review_complex(spark, sf) -> DataFrame:
    return _review(spark, sf)


@query
def review_simple(spark, sf) -> DataFrame:
    detailed = reconcile.with_details(I.keyed_unified(spark, sf, but=(ROW_IDS, OBS_KEY)))
    simple = reconcile.unnest_simple(detailed, I.reference(spark, sf), I.narratives(spark, sf))
    return review.review_simple(simple)


@query
def review_stats(spark, sf) -> DataFrame:
    stats = review.review_stats(_review(spark, sf))
    return stats.withColumn("match_rate", rounded("match_rate"))


# ---- merge -------------------------------------------------------------------------


def _keyed(spark, sf, of=I.survey) -> DataFrame:
    return prepare.with_keys(of(spark, sf), I.OPTIONS)


def _merged(spark, sf) -> DataFrame:
    texts = prepare.distinct_texts(I.survey(spark, sf), "OBS_400A")
    return merge.merge_review(_keyed(spark, sf), _review(spark, sf), text_col="OBS_400A", texts=texts)


@query
def merge_complex(spark, sf) -> DataFrame:
    return _merged(spark, sf).select(
        "HOGAR", "P201", "ID", "P424_ID", F.md5("OBS_400A").alias("text_md5"), ROW_ID,
        *merge.COMPLEX_COLUMNS,
    )


@query
def merge_salted(spark, sf) -> DataFrame:
    """The same join for a survey with a third of its rows under one row id; the query fails
    if no row id is salted."""
    of = I.survey_hot_row
    merged = merge.merge_review(
        _keyed(spark, sf, of), _review(spark, sf, of), min_rows=1, at_least=1
    )
    return merged.select(ROW_ID, "P424_ID", "MATCH_DELITO", "ESTADO_REVISION")


@query
def merge_upsert(spark, sf) -> DataFrame:
    """The original already has some review columns; the review key has another name."""
    original = _keyed(spark, sf).select(
        ROW_ID, "HOGAR",
        F.when(F.col("HOGAR") % 2 == 0, "anterior").alias("DETALLE_ERRORES_MODELO"),
        F.lit(9).alias("ESTADO_REVISION"),
    )
    reviewed = _review(spark, sf).withColumnRenamed(ROW_ID, "CLAVE")
    return merge.merge_review(
        original, reviewed, ["DETALLE_ERRORES_MODELO", "ESTADO_REVISION", "MATCH_DELITO"],
        review_key="CLAVE",
    )


@query
def merge_label(spark, sf) -> DataFrame:
    return merge.with_match_label(_merged(spark, sf)).select(
        ROW_ID, "match_label", "match_color"
    )


@query
def merge_simple(spark, sf) -> DataFrame:
    """Ids as floats, texts and nulls on the original against texts on the review."""
    key = F.col("o_orderkey")
    base = F.col("o_custkey")
    orders = I.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 0, base.cast("double").cast("string"))
        .when(key % 3 == 1, F.concat(F.lit(" "), base.cast("string")))
        .when(key % 7 != 0, base.cast("string")).alias("ID"),
    )
    reviewed = (
        I.answers(spark, sf)
        .select(F.col("h").cast("string").alias("ID_DELITO_IA"), F.col("id"), "observacion",
                clean_reasoning(F.col("razonamiento_modelo")).alias("RAZONAMIENTO_GENERAL"))
    )
    return merge.merge_simple(orders, reviewed, "ID", order=["id", "observacion"])


def _partly_unknown(spark, sf) -> DataFrame:
    """A review of which some ids are unknown to the original."""
    foreign = F.concat(ROW_ID, F.when(F.col("DELITO_ESPERADO") == "7", "-X").otherwise(""))
    return _review(spark, sf).withColumn(ROW_ID, foreign)


@query
def merge_unknown_ids(spark, sf) -> DataFrame:
    return merge.ids_not_in_original(_partly_unknown(spark, sf), _keyed(spark, sf))


@query
def merge_stats(spark, sf) -> DataFrame:
    reviewed = _partly_unknown(spark, sf)
    original = _keyed(spark, sf)
    stats = merge.merge_stats(merge.merge_review(original, reviewed), reviewed, original)
    for c in ("match_rate", "coverage", "analysis_coverage"):
        stats = stats.withColumn(c, rounded(c))
    return stats


# ---- repeated runs -----------------------------------------------------------------


@query
def attempt_similarity(spark, sf) -> DataFrame:
    similarity = consistency.attempt_similarity(I.attempts(spark, sf))
    return similarity.select(
        "obs_id", "n_attempts", "n_readable", rounded("similarity").alias("similarity"), "tier",
        joined("common_codes").alias("common_codes"), joined("all_codes").alias("all_codes"),
    )


@query
def attempt_codes(spark, sf) -> DataFrame:
    return consistency.attempt_codes(I.attempts(spark, sf)).withColumn("pct", rounded("pct"))


@query
def attempt_parse(spark, sf) -> DataFrame:
    raw = I.answers(spark, sf).withColumn("v", J.strict_variant(T.strip_ws(F.col("raw_response"))))
    return raw.select(
        "id", F.md5("observacion").alias("text_md5"),
        joined(R.attempt_codes(F.col("v"))).alias("codes"),
    )


# ---- whole run ---------------------------------------------------------------------


@query
def full_run(spark, sf) -> DataFrame:
    return _run_rows(spark, sf, I.OPTIONS)


def _run_rows(spark, sf, options) -> DataFrame:
    run = run_review(I.survey(spark, sf), options, I.PROMPTS, I.length_model)
    return run.merged.select(
        ROW_ID, F.md5("OBS_400A").alias("text_md5"), "MATCH_DELITO", "ESTADO_REVISION",
        "JUSTIFICACION_ACIERTO", "DETALLE_ERRORES_MODELO", "RAZONAMIENTO_GENERAL",
    )


@query
def full_run_every_narrative(spark, sf) -> DataFrame:
    """The run in which all narratives of a household are reviewed, not just the last."""
    return _run_rows(spark, sf, replace(I.OPTIONS, result_key="id_text"))


@query
def full_run_simple(spark, sf) -> DataFrame:
    """The run over a flat table: one id, one text, no code."""
    run = run_review(I.table(spark, sf, "documents"), I.DOCUMENTS, I.PROMPTS, I.length_model)
    return run.merged.select("doc_id", F.md5("text").alias("text_md5"), "RAZONAMIENTO_GENERAL")


@query
def run_reports(spark, sf) -> DataFrame:
    """The numbers of a run, counted while its tables are written."""
    run = run_review(I.survey(spark, sf), I.OPTIONS, I.PROMPTS, I.length_model)
    folder = f"{shared_folder(spark).rstrip('/')}/surveyqc/out-{uuid.uuid4().hex}"
    found = run.write(folder).rows()
    return spark.createDataFrame(found, "report string, name string, value double").withColumn("value", rounded("value"))

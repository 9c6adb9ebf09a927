"""Survey, response, batch-line and attempt tables derived from the given tables.

Every table is read whole and every text is used whole. The arithmetic on keys only
decides what a row looks like (a missing code, a cut-off response …), never whether it
is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveyqc import SurveyOptions
from surveyqc.operators import infer, prepare, reconcile
from surveyqc.operators.once import with_once
from surveyqc.operators.prepare import BASE_ID, CLEAN, CODES, OBS_KEY, ROW_IDS, TEXT_KEY, TEXT_ORDER
from surveyqc.operators.prompts import Prompts

OPTIONS = SurveyOptions()
LOOSE = SurveyOptions(pattern_min_count=3, pattern_min_percent=0.3)
DOCUMENTS = SurveyOptions.simple(id_col="doc_id", text_col="text", code_col=None)

#: What the offline classifier is told.
PROMPTS = Prompts(
    system="\n".join([
        "You read what people reported to a housing office and name the kinds of fault in it.",
        "",
        "4 = no heating", "11 = water comes in", "17 = noise at night", "26 = lift out of order",
        "",
        "A fault that was mended before the report has no kind.",
        "One report may have several kinds, and each is named once.",
        "",
        "Report: the cellar was under water again.",
        "Kinds: 11",
    ]),
    user="Report:\n{text}\n\nKinds, as JSON:",
    sizes={"rules": 2, "codes": 4, "examples": 1},
)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once per path."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def survey(spark: SparkSession, sf: str, orders="true") -> DataFrame:
    """One row per order: a customer is a household, the order day the code, a document
    the narrative. Some codes are null; some households have two narratives."""
    documents = table(spark, sf, "documents").select("doc_id", F.col("text").alias("OBS_400A"))
    n_docs = documents.agg(F.count(F.lit(1))).scalar()
    key = F.col("o_orderkey")
    shift = F.when(key % 17 == 0, 1).otherwise(0)
    # a row of keys becomes a row with a whole text: spread the keys before that
    cores = spark.sparkContext.defaultParallelism
    return (
        table(spark, sf, "orders")
        .filter(orders)
        .repartition(cores, "o_orderkey")
        .select(
            F.col("o_custkey").alias("HOGAR"),
            (key % 2).alias("P201"),
            (F.floor(key / 2) % 2).alias("ID"),
            F.when(key % 50 != 0, F.dayofmonth("o_orderdate").cast("bigint")).alias("P424_ID"),
            ((F.col("o_custkey") + shift) % n_docs).alias("doc_id"),
        )
        .join(documents, "doc_id")
        .drop("doc_id")
    )


#: Rows of one household that make up a third of a survey, and their narrative.
HOT_EVERY, HOT_HOUSEHOLD, HOT_DOCUMENT = 3, 0, 0


def _with_hot_household(spark: SparkSession, sf: str, code) -> DataFrame:
    documents = table(spark, sf, "documents")
    text = documents.filter(F.col("doc_id") == HOT_DOCUMENT).select("text").scalar()
    orders = table(spark, sf, "orders").filter(F.col("o_orderkey") % HOT_EVERY == 0)
    zero = F.lit(HOT_HOUSEHOLD).cast("bigint")
    hot = orders.select(
        zero.alias("HOGAR"), zero.alias("P201"), zero.alias("ID"), code.cast("bigint").alias("P424_ID"),
        text.alias("OBS_400A"),
    )
    return survey(spark, sf, F.col("o_orderkey") % HOT_EVERY != 0).unionByName(hot)


def survey_hot_row(spark: SparkSession, sf: str) -> DataFrame:
    """The survey with a third of its rows under one row id."""
    return _with_hot_household(spark, sf, F.lit(7))


def survey_hot_group(spark: SparkSession, sf: str) -> DataFrame:
    """The survey with a third of its rows in one household, narrative and all, each under
    a code of its own."""
    return _with_hot_household(spark, sf, F.col("o_orderkey"))


def cleaned(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    return prepare.with_clean_text(prepare.with_keys(of(spark, sf), OPTIONS), OPTIONS)


def valid(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    return prepare.valid_rows(cleaned(spark, sf, of), OPTIONS)


def narratives(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    """The distinct narratives that pass the gate, dealt by their key."""
    return prepare.dealt_by_key(prepare.valid_rows(prepare.narratives(of(spark, sf), OPTIONS), OPTIONS))


def keyed_valid(spark: SparkSession, sf: str, of=survey, ordered: bool = True) -> DataFrame:
    """Rows whose narrative passes the gate with its keys in place of it, and the number that
    sorts it if rows are to be ``ordered``."""
    texts = narratives(spark, sf, of)
    texts = prepare.with_text_order(texts) if ordered else texts
    return prepare.with_narratives(prepare.with_keys(of(spark, sf), OPTIONS), texts, OPTIONS)


def keyed_groups(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    """Groups with the key of their narrative in place of it, made whole whichever of their
    columns are read, so that all that one job makes of them shares one grouping."""
    made = prepare.group_observations(keyed_valid(spark, sf, of), OPTIONS)
    return with_once(made, **{c: F.col(c) for c in made.columns})


def groups(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    whole = prepare.with_texts(keyed_groups(spark, sf, of), narratives(spark, sf, of))
    return whole.select(BASE_ID, CLEAN, CODES, ROW_IDS)


def _quoted(code, quoted):
    return F.when(quoted, F.concat(F.lit('"'), code, F.lit('"'))).otherwise(code)


def _observed(df: DataFrame, spark: SparkSession, sf: str, of) -> DataFrame:
    """The narrative in place of its keys, which were ``KEYS``."""
    whole = prepare.with_texts(df, narratives(spark, sf, of), "observacion")
    order = ["observacion" if c == OBS_KEY else c for c in df.columns if c not in (TEXT_KEY, TEXT_ORDER)]
    return whole.select(*order)


#: What stands for a narrative until the joins are done.
KEYS = [OBS_KEY, TEXT_KEY, TEXT_ORDER]


def answers(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    return _observed(keyed_answers(spark, sf, of), spark, sf, of)


def keyed_answers(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    """Groups with a made-up raw response of every shape: right, wrong, ambiguous, empty,
    cut off, wrapped in text, with trailing garbage, a bare list, a bare number."""
    h = F.split(BASE_ID, "-")[0].cast("bigint")
    codes = F.col(CODES)
    plus_99 = F.concat(codes, F.array(F.lit("99")))
    predicted = (
        F.when(h % 11 == 0, F.array().cast("array<string>"))
        .when(h % 7 == 0, F.array(F.lit("30")))
        .when(h % 23 == 0, F.array(F.lit("99")))
        .when(
            h % 29 == 0,
            F.concat(F.slice(codes, F.lit(1), F.greatest(F.size(codes) - 1, F.lit(0))),
                     F.array(F.lit("99"))),
        )
        .when(h % 3 == 0, plus_99)
        .otherwise(codes)
    )
    reasoning = F.concat(
        F.lit("1. Leo el caso "), h.cast("string"), F.lit("."),
        F.when(h % 5 == 0, " 4. No hay más eventos delictivos en la observación."
               " 5. Construyo el JSON final con lo hallado.")
        .when(h % 5 == 1, " 4. Otro hecho aparte. 5. Construyo el JSON final.")
        .when(h % 5 == 2, " 4. no hay otros eventos delictivos mencionados en la observación, nada.")
        .otherwise(""),
        F.when(h % 19 == 0, " Fallback").otherwise(""),
    )

    def item(c):
        why = F.when(
            F.col("h") % 31 != 4,
            F.concat(F.lit(',"justificacion":"por '), c, F.lit('"')),
        ).otherwise("")
        name = _quoted(c, F.col("h") % 5 != 2)
        return F.concat(F.lit('{"codigo":'), name, why, F.lit("}"))

    listed = F.concat(F.lit("["), F.array_join(F.transform("given", item), ","), F.lit("]"))
    payload = F.concat(
        F.lit('{"razonamiento":"'), F.col("razonamiento_modelo"),
        F.lit('","clasificaciones":'), F.col("listed"), F.lit("}"),
    )
    p, hh = F.col("payload"), F.col("h")
    raw = (
        F.when(hh % 13 == 0, F.substr(p, F.lit(1), F.length(p) - 3))
        .when(hh % 13 == 1, F.concat(F.lit("Respuesta: "), p))
        .when(hh % 13 == 2, F.concat(p, F.lit("x")))
        .when(hh % 13 == 3, F.col("listed"))
        .when(hh % 13 == 4, F.lit(""))
        .when(hh % 13 == 5, F.lit("5"))
        .otherwise(p)
    )
    return (
        keyed_groups(spark, sf, of)
        .withColumn("h", h)
        .withColumn("given", predicted)
        .withColumn("razonamiento_modelo", reasoning)
        .withColumn("listed", listed)
        .withColumn("payload", payload)
        .select(
            F.col(BASE_ID).alias("id"),
            "h",
            *KEYS,
            F.col(CODES).alias("expected_codes"),
            ROW_IDS,
            "razonamiento_modelo",
            raw.alias("raw_response"),
        )
    )


def records(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    return _observed(keyed_records(spark, sf, of), spark, sf, of)


def keyed_records(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    """Answers as response records: predicted codes as parsed from the raw response."""
    parsed = infer.parse_responses(keyed_answers(spark, sf, of))
    return parsed.select(
        "id",
        "h",
        *KEYS,
        "expected_codes",
        ROW_IDS,
        F.col("parsed.codes").alias("predicted_codes"),
        "razonamiento_modelo",
        "raw_response",
        F.lit("2025-01-01T00:00:00").alias("timestamp"),
        F.when(F.col("parsed.failed"), True).alias("error"),
    )


def unified(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    return _observed(keyed_unified(spark, sf, of), spark, sf, of)


def keyed_unified(spark: SparkSession, sf: str, of=survey, but: tuple = ()) -> DataFrame:
    """The last record per id, by narrative. Columns in ``but``, which nothing reads later,
    are left out before the records are shuffled."""
    return reconcile.last_wins(keyed_records(spark, sf, of).drop(*but), ["id"], [TEXT_ORDER])


def reference(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    """Row ids per id, taken from the last group per id; the grouping is that of the records."""
    cases = keyed_groups(spark, sf, of).select(F.col(BASE_ID).alias("id"), TEXT_ORDER, ROW_IDS)
    return reconcile.last_wins(cases, ["id"], [TEXT_ORDER]).select("id", ROW_IDS)


def unnested(spark: SparkSession, sf: str, of=survey) -> DataFrame:
    detailed = reconcile.with_details(keyed_unified(spark, sf, of, (ROW_IDS, OBS_KEY)))
    return reconcile.unnest(detailed, reference(spark, sf, of), narratives(spark, sf, of))


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Batch-file lines ``(file, pos, text_order, value)``, the third a number for ``pos``: three spellings of the id field, null ids,
    broken lines, lists, and second passes in a file whose name sorts elsewhere."""
    r = keyed_answers(spark, sf).drop("expected_codes", ROW_IDS)
    r = prepare.with_texts(r, narratives(spark, sf), "observacion")
    passes = F.when(F.col("h") % 9 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    r = r.withColumn("pass", F.explode(passes))
    h = F.col("h")
    other = F.when(h % 53 == 7, F.concat("id", F.lit("-X"))).otherwise(F.col("id"))
    r = r.withColumn("sent_id", other)
    body = F.struct(
        "observacion",
        F.concat("razonamiento_modelo", F.lit(" Pasada "), F.col("pass").cast("string")).alias(
            "razonamiento_modelo"
        ),
        "raw_response",
    )
    rest = F.substr(F.to_json(body), F.lit(2))
    named = F.concat(
        F.when(h % 37 == 5, F.concat(F.lit('{"id":null,"case_id":"'), "sent_id", F.lit('",')))
        .when(h % 6 == 4, F.concat(F.lit('{"case_id":"'), "sent_id", F.lit('",')))
        .when(h % 6 == 5, F.concat(F.lit('{"id_observacion":"'), "sent_id", F.lit('",')))
        .otherwise(F.concat(F.lit('{"id":"'), "sent_id", F.lit('",'))),
        rest,
    )
    value = (
        F.when(h % 41 == 3, F.substr(named, F.lit(1), F.length(named) - 2))
        .when(h % 43 == 2, F.lit("[1]"))
        .when(h % 61 == 6, F.lit("17"))
        .otherwise(named)
    )
    number = (h + F.col("pass")) % 12 + 1
    return r.select(
        F.concat(F.lit("resultados_lote_"), number.cast("string"), F.lit("_2025.jsonl")).alias(
            "file"
        ),
        F.col("observacion").alias("pos"),
        TEXT_ORDER,
        value.alias("value"),
    )


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Four attempts per user: an attempt's codes are its event types. An attempt whose
    smallest value is low counts as unreadable."""
    return (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("obs_id"), (F.col("event_id") % 4).alias("attempt"))
        .agg(F.collect_set(F.concat("event_type", F.floor(F.col("value") % 3).cast("string")))
             .alias("codes"),
             F.count(F.lit(1)).alias("n"))
        .select("obs_id", "attempt", F.when(F.col("n") % 5 != 0, F.col("codes")).alias("codes"))
    )


def length_model(prompts):
    """Offline classifier: the code is the prompt length modulo 31 plus 1; some answers
    are wrapped in text, some calls fail."""
    out = []
    for _, user in prompts:
        n = len(user)
        text = (
            '{"razonamiento":"Largo %d. 5. Construyo el JSON final.","clasificaciones":'
            '[{"codigo":"%d","justificacion":"largo"}]}' % (n, n % 31 + 1)
        )
        if n % 10 == 3:
            text = "Respuesta: " + text
        out.append(RuntimeError("sin respuesta") if n % 10 == 7 else text)
    return out

"""Narratives stay where they are while their rows are grouped, compared and joined by keys."""

import re

from pyspark.sql import functions as F

from surveyqc import SurveyOptions
from surveyqc.operators import durable, infer, merge, prepare, reconcile
from surveyqc.operators.prepare import BASE_ID, CLEAN, CODES, OBS_KEY, ROW_ID, ROW_IDS, TEXT_KEY, TEXT_ORDER
from surveyqc.operators.prompts import Prompts

OPTIONS = SurveyOptions(min_chars=3, min_words=1)
HEAD = "una historia que empieza igual que otra y que sigue asi sin parar jamas "  # longer than a head
ROWS = [
    (1, 0, 0, 4, "casa robada"), (1, 0, 0, 5, "  casa   robada"), (1, 0, 0, 5, "casa robada"),
    (1, 0, 0, 4, "barco perdido"), (2, 0, 0, None, HEAD + "fin"), (2, 0, 0, 7, HEAD + "alto"),
    (2, 0, 0, 7, HEAD + "fin"), (3, 0, 0, 7, None), (3, 0, 0, 7, "x"), (None, 0, 0, 1, "casa robada"),
]


def survey(spark):
    names = ("HOGAR", "P201", "ID", "P424_ID")
    return spark.createDataFrame(ROWS, ", ".join(f"{n} bigint" for n in names) + ", OBS_400A string")


def keyed(spark):
    texts = prepare.valid_rows(prepare.narratives(survey(spark), OPTIONS), OPTIONS)
    rows = prepare.with_narratives(
        prepare.with_keys(survey(spark), OPTIONS), prepare.with_text_order(texts), OPTIONS)
    return prepare.group_observations(rows, OPTIONS), texts


def exchanged(df) -> list[str]:
    """What each shuffle of the plan moves."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]", plan)


def plain_groups(spark):
    rows = prepare.with_clean_text(prepare.with_keys(survey(spark), OPTIONS), OPTIONS)
    return prepare.group_observations(prepare.valid_rows(rows, OPTIONS), OPTIONS)


def test_groups_by_key_are_those_by_text(spark):
    groups, texts = keyed(spark)
    columns = [BASE_ID, CLEAN, CODES, ROW_IDS]
    got = prepare.with_texts(groups, texts).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain_groups(spark).select(*columns).collect()))
    assert got.count() == 5


def test_a_number_sorts_as_the_text_beyond_its_head(spark):
    groups, texts = keyed(spark)
    last = reconcile.last_wins(groups, [BASE_ID], [TEXT_ORDER])
    got = {r[BASE_ID]: r[CLEAN] for r in prepare.with_texts(last, texts).collect()}
    want = reconcile.last_wins(plain_groups(spark), [BASE_ID], [CLEAN]).collect()
    assert got == {r[BASE_ID]: r[CLEAN] for r in want}
    assert got["2-0-0"].endswith("fin")


def test_unused_texts_are_not_fetched(spark):
    groups, texts = keyed(spark)
    cases = groups.withColumnRenamed(BASE_ID, "id")
    records = reconcile.last_wins(cases, ["id"], [TEXT_ORDER]).select(
        "id", TEXT_KEY, F.col(CODES).alias("expected_codes"), F.col(CODES).alias("predicted_codes"),
        F.lit("").alias("razonamiento_modelo"), F.lit("").alias("raw_response"), F.lit("").alias("timestamp"),
        F.lit(False).alias("error"))
    reference = reconcile.last_wins(cases, ["id"], [TEXT_ORDER]).select("id", ROW_IDS)
    unnested = reconcile.unnest(reconcile.with_details(records), reference, texts)
    joins = [str(df._jdf.queryExecution().optimizedPlan()).count("Join LeftOuter")
             for df in (unnested, unnested.select("id_delito_ia", "expected_codes_obs"))]
    assert joins == [1, 0]
    by_id = [moved for moved in exchanged(unnested) if "id#" in moved.replace("_id#", "")]
    assert not any("observacion" in moved or "OBS_400A" in moved for moved in by_id)


def test_merge_moves_the_text_by_its_digest(spark):
    original = prepare.with_keys(survey(spark), OPTIONS)
    reviewed = spark.createDataFrame(
        [("1-0-0-5", True, "a"), ("1-0-0-5", False, "b"), ("3-0-0-7", True, None), ("9-9-9-9", True, "c")],
        f"{ROW_ID} string, MATCH_DELITO boolean, DETALLE_ERRORES_MODELO string")
    columns = ["MATCH_DELITO", "DETALLE_ERRORES_MODELO"]
    whole = merge.merge_review(original, reviewed, columns)
    apart = merge.merge_review(original, reviewed, columns, text_col="OBS_400A")
    assert apart.columns == whole.columns
    assert sorted(map(str, apart.collect())) == sorted(map(str, whole.collect()))

    def with_rows(df):
        return [moved for moved in exchanged(df) if "OBS_400A" in moved and "HOGAR" in moved]

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert with_rows(whole) and not with_rows(apart)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rejected_rows_keep_their_original_text(spark):
    texts = prepare.prepared_texts(survey(spark), OPTIONS)
    rows = prepare.prepared_rows(survey(spark), texts, OPTIONS)
    assert "OBS_400A" not in rows.columns and CLEAN not in rows.columns
    rejected = prepare.rejected_texts(rows, texts, OPTIONS).collect()
    assert sorted((r.id_delito_ia, r.observacion_original, r[CLEAN]) for r in rejected if r.observacion_original) == [
        ("3-0-0-7", "x", "x")]
    assert [(r.id_delito_ia, r[CLEAN]) for r in rejected if r.observacion_original is None] == [("3-0-0-7", "")]


def test_waves_fetch_the_texts_of_what_they_ask(spark, tmp_path):
    texts = spark.createDataFrame([("k1", "uno"), ("k2", "dos"), ("k3", "tres")], "obs_key string, observacion string")
    cases = spark.createDataFrame(
        [("a", "k1"), ("b", "k1"), ("a", "k2"), (None, "k2"), ("c", "k1")], "id string, obs_key string")
    asked = durable.classify_in_waves(
        cases, Prompts("s", "[{text}]"), lambda pairs: [user for _, user in pairs],
        durable.AnswerLog(str(tmp_path), "r"), ["id", "obs_key"], batch_size=2, wave_batches=1, texts=texts)
    got = sorted((r.id or "", r.obs_key, r.raw_response) for r in asked.collect())
    assert got == [("", "k2", "[dos]"), ("a", "k1", "[uno]"), ("a", "k2", "[dos]"), ("b", "k1", "[uno]"),
                   ("c", "k1", "[uno]")]


def test_texts_are_read_once_however_many_waves(spark, tmp_path):
    read = str(tmp_path / "read")

    @F.udf("string")
    def noted(text):
        with open(read, "a") as f:
            f.write("x")
        return text

    rows = [(f"k{i}", f"texto {i}") for i in range(3)]
    texts = spark.createDataFrame(rows, "obs_key string, observacion string")
    texts = texts.withColumn("observacion", noted.asNondeterministic()("observacion"))
    cases = spark.range(24).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("obs_key"))
    store = durable.AnswerLog(str(tmp_path / "answers"), "r")
    asked = durable.classify_in_waves(
        cases, Prompts("s", "[{text}]"), lambda pairs: [user for _, user in pairs], store, ["id", "obs_key"],
        batch_size=2, wave_batches=2, texts=texts)
    assert {(r.id, r.raw_response) for r in asked.collect()} == {(str(i), f"[texto {i % 3}]") for i in range(24)}
    assert [tuple(r) for r in store.commits(spark).orderBy("wave").collect()] == [(w, 2, 4, 0) for w in range(1, 7)]
    assert len(open(read).read()) == 3


def keyed_rows(spark, ordered):
    texts = prepare.dealt_by_key(prepare.valid_rows(prepare.narratives(survey(spark), OPTIONS), OPTIONS))
    placed = prepare.with_text_order(texts) if ordered else texts
    return prepare.with_narratives(prepare.with_keys(survey(spark), OPTIONS), placed, OPTIONS), texts


def plain_rows(spark):
    return prepare.valid_rows(prepare.with_clean_text(prepare.with_keys(survey(spark), OPTIONS), OPTIONS), OPTIONS)


def test_the_example_by_keys_is_that_by_texts(spark):
    rows, texts = keyed_rows(spark, False)
    got = prepare.with_texts(prepare.group_example(rows, OPTIONS), texts).drop(TEXT_KEY)
    want = prepare.group_example(plain_rows(spark), OPTIONS)
    assert got.columns == want.columns and got.count() == 4
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_batches_by_keys_are_those_by_texts(spark):
    rows, texts = keyed_rows(spark, True)
    keyed = infer.assign_batches(prepare.group_codes(rows, OPTIONS), [BASE_ID, TEXT_ORDER], 2)
    plain = infer.assign_batches(prepare.group_codes(plain_rows(spark), OPTIONS), [BASE_ID, CLEAN], 2)
    got = prepare.with_texts(keyed, texts).select(BASE_ID, CLEAN, "batch_id").collect()
    assert sorted(map(str, got)) == sorted(map(str, plain.select(BASE_ID, CLEAN, "batch_id").collect()))


def test_order_and_texts_share_one_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, texts = keyed_rows(spark, True)
        whole = prepare.with_texts(prepare.with_text_order(texts).select(TEXT_KEY, OBS_KEY, TEXT_ORDER), texts)
        assert whole.count() == 5
        rows = whole.collect()  # the plan as it ran
        plan = whole._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan and plan.count("ALTERNATIVA") == 1
        assert {r[CLEAN] for r in rows} == {"casa robada", "barco perdido", HEAD + "fin", HEAD + "alto"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_merge_takes_texts_that_are_at_hand(spark):
    original = prepare.with_keys(survey(spark), OPTIONS)
    reviewed = spark.createDataFrame([("1-0-0-5", True), ("3-0-0-7", False)], f"{ROW_ID} string, MATCH_DELITO boolean")
    texts = prepare.distinct_texts(survey(spark), "OBS_400A")
    whole = merge.merge_review(original, reviewed, ["MATCH_DELITO"])
    apart = merge.merge_review(original, reviewed, ["MATCH_DELITO"], text_col="OBS_400A", texts=texts)
    assert sorted(map(str, apart.collect())) == sorted(map(str, whole.collect()))
    assert [r.OBS_400A for r in apart.collect()].count(None) == 1

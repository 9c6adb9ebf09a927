import math
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from checks import inputs as I
from checks.catalog import QUERIES
from surveyqc.operators import durable, infer, prepare
from surveyqc.operators.prepare import ROW_ID
from surveyqc.operators.prompts import Prompts, prompt_stats, render_prompts
from surveyqc.options import SurveyOptions
from surveyqc.plans.full_run import run_review

SF = "/root/testdata/sf0.001"
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_batches_are_contiguous(spark):
    df = spark.range(1003).select((F.col("id") * 7919 % 1003).alias("k"))
    got = {r.k: r.batch_id for r in infer.assign_batches(df, ["k"], 100).collect()}
    assert got == {k: k // 100 + 1 for k in range(1003)}
    assert max(got.values()) == math.ceil(1003 / 100)


def cases(spark, texts):
    rows = [(str(i), t, ["9 ", "10", "9"], ["a"]) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "id string, observacion string, expected_codes array<string>, ids_delito_originales array<string>"
    )


def test_one_record_per_case_in_any_event(spark):
    def model(prompts):
        if any("todo mal" in user for _, user in prompts):
            raise RuntimeError("caída")
        return [ValueError("no") if "mal" in user else
                '[]' if "lista" in user else
                '{"razonamiento":"r","clasificaciones":[{"codigo":"9"}]}' for _, user in prompts]

    df = cases(spark, ["bien", "mal", "todo mal", "lista", None])
    got = {r.id: r for r in infer.to_records(infer.classify(df, I.PROMPTS, model, parallelism=2)).collect()}
    assert len(got) == 5
    assert (got["0"].predicted_codes, got["0"].error, got["0"].expected_codes) == (["9"], False, ["10", "9"])
    assert got["4"].error is False
    for i, said in (("1", "no"), ("2", "caída")):
        assert (got[i].error, got[i].predicted_codes, got[i].raw_response) == (True, [], "")
        assert got[i].razonamiento_modelo == "Error en procesamiento: " + said
        assert got[i].expected_codes == ["9 ", "10", "9"]
    assert got["3"].error is True and got["3"].predicted_codes == []
    assert all(r.timestamp for r in got.values())


def test_wrong_number_of_answers(spark):
    df = infer.classify(cases(spark, ["a", "b"]), I.PROMPTS, lambda prompts: ["x", "y", "z"])
    assert [r.call_error for r in df.collect()] == ["3 answers for 1 prompts"] * 2


def test_prompts(spark):
    prompts = Prompts("all of it", "« {text} » {x}", {"codes": 7})
    df = cases(spark, ["x", None])
    r = render_prompts(df, prompts).orderBy("id").collect()
    assert [(x.system_prompt, x.user_prompt) for x in r] == [("all of it", "« x » {x}"), ("all of it", "«  » {x}")]
    s = prompt_stats(df, prompts).first()
    assert (s.cases, s.system_chars, s.user_chars, s.total_chars, s.n_codes) == (2, 9, 17, 35, 7)
    assert s.approx_words == (9 + 9) // 5 + (9 + 8) // 5
    with pytest.raises(ValueError):
        Prompts("s", "no place for it")


def test_prompts_from_columns(spark):
    """The user prompt may be any expression over the cases."""
    def with_id(text):
        return F.concat(F.col("id"), F.lit("|"), F.upper(text))

    got = infer.classify(cases(spark, ["a", "b"]), Prompts("s", with_id), lambda ps: [f"{s}:{u}" for s, u in ps])
    assert {r.id: r.raw_response for r in got.collect()} == {"0": "s:0|A", "1": "s:1|B"}


NARRATIVES = ["le robaron el celular en la calle", "entraron a la casa por la ventana"]


def echo_model(prompts):
    """Code 9 for the first narrative, nothing for the other."""
    return ['{"razonamiento":"visto","clasificaciones":[%s]}'
            % ('{"codigo":"9","justificacion":"celular"}' if "celular" in user else "")
            for _, user in prompts]


def raw(spark):
    rows = [(1, 1, 1, 9, NARRATIVES[0]), (1, 1, 1, 2, NARRATIVES[0]), (1, 1, 1, 9, NARRATIVES[0]),
            (1, 1, 1, 4, NARRATIVES[1]), (2, 1, 1, 9, NARRATIVES[0]), (3, 1, 1, 9, "corto")]
    return spark.createDataFrame(rows, "HOGAR int, P201 int, ID int, P424_ID int, OBS_400A string")


def states(run):
    return sorted((r[ROW_ID], r.MATCH_DELITO, r.ESTADO_REVISION) for r in run.merged.collect())


def test_complex_run_keeps_last_narrative_per_id(spark):
    run = run_review(raw(spark), SurveyOptions(), I.PROMPTS, echo_model)
    assert states(run) == [
        ("1-1-1-2", False, 2), ("1-1-1-4", None, 4), ("1-1-1-9", True, 1), ("1-1-1-9", True, 1),
        ("2-1-1-9", True, 1), ("3-1-1-9", None, 4),
    ]
    assert run.cases.count() == 3 and run.rejected.count() == 1
    assert run.unified.count() == 2 and run.issues.count() == 0
    assert {r.format_class for r in run.formats.collect()} == {"A"}


def test_complex_run_with_every_narrative(spark):
    run = run_review(raw(spark), SurveyOptions(result_key="id_text"), I.PROMPTS, echo_model)
    assert ("1-1-1-4", False, 5) in states(run) and len(states(run)) == 6


def test_simple_run(spark):
    df = spark.createDataFrame(
        [(1, NARRATIVES[0]), (2, NARRATIVES[1]), (3, "corto"), (None, "corto")], "ID int, DESCRIPCION1 string"
    )
    run = run_review(df, SurveyOptions.simple(), I.PROMPTS, echo_model)
    got = {r.ID: r.RAZONAMIENTO_GENERAL for r in run.merged.collect()}
    assert got == {1: "visto", 2: "visto", 3: "", None: None}
    assert {r.ID_DELITO_IA: r.CODIGOS_PREDICHOS for r in run.review.collect()} == {"1": "9", "2": "Ninguno"}


def test_model_is_asked_once_per_case(spark, tmp_path):
    log = str(tmp_path / "asked")

    def counting(prompts):
        with open(log, "a") as f:
            f.write("x" * len(prompts))
        return echo_model(prompts)

    run = run_review(raw(spark), SurveyOptions(), I.PROMPTS, counting, parallelism=3)
    for df in (run.merged, run.issues, run.formats, run.review):
        df.count()
    assert len(open(log).read()) == 2  # the first narrative of household 1 is not used


@pytest.mark.parametrize("key", ["id", "id_text"])
def test_reports_are_those_of_the_tables(spark, tmp_path, key):
    """Counted while the tables are written, against the operators on the finished tables."""
    from surveyqc.operators import merge, prefixes, reconcile, review, triage

    options = SurveyOptions(result_key=key, pattern_min_count=2, pattern_min_percent=10.0)
    run = run_review(raw(spark), options, I.PROMPTS, echo_model)
    reports = run.write(str(tmp_path / "out"))
    out = {name: spark.read.parquet(str(tmp_path / "out" / name)) for name in ("records", "review", "merged")}
    assert out["merged"].exceptAll(run.merged).count() == run.merged.exceptAll(out["merged"]).count() == 0
    v = review.review_stats(out["review"]).first()
    assert list(reports.review.values()) == [v.total_records, v.matches, v.match_rate, v.false_negatives]
    keyed = prepare.with_keys(raw(spark), options)
    m = merge.merge_stats(out["merged"], out["review"], keyed).first()
    assert reports.merge == {
        "rows": m.total_rows, "analysed": m.records_with_analysis, "matches": m.successful_matches, "match_pct": m.match_rate,
        "coverage_pct": m.coverage, "unknown_ids": m.missing_in_original, "analysis_coverage_pct": m.analysis_coverage}
    for r in triage.format_distribution(run.formats).collect():
        assert (reports.formats[f"{r.format_class}_records"], reports.formats[f"{r.format_class}_pct"]) == (r.n, r.pct)
    assert reports.reconciled == {
        "records": run.unified.count(), "unnested": run.unnested.count(), "issues": reconcile.parse_issues(run.detailed).count()}
    g = prepare.group_stats(rows_of(spark, options), run.cases).first()
    assert list(reports.groups.values()) == [g.filas_antes, g.filas_despues, g.reduccion, g.reduccion_pct]
    texts = run.cases.withColumn("after", prefixes.remove_prefixes(F.col(prepare.CLEAN), run.patterns))
    p = prefixes.removal_stats(texts, prepare.CLEAN, "after", run.patterns).first()
    assert list(reports.prefixes.values()) == pytest.approx(
        [p.total_processed, p.total_cleaned, p.cleaned_pct, p.reduction_pct, p.patterns_1, p.patterns_2, p.patterns_3])


def rows_of(spark, options):
    return prepare.valid_rows(prepare.with_clean_text(prepare.with_keys(raw(spark), options), options), options)


def test_reports_of_simple_and_empty_runs(spark, tmp_path):
    df = spark.createDataFrame([(1, NARRATIVES[0]), (2, NARRATIVES[1]), (3, "corto")], "ID int, DESCRIPCION1 string")
    simple = run_review(df, SurveyOptions.simple(), I.PROMPTS, echo_model).write(str(tmp_path / "a"))
    assert simple.merge["rows"] == 3 and simple.merge["analysed"] == 2 and simple.review["rows"] == 2
    none = run_review(raw(spark).limit(0), SurveyOptions(), I.PROMPTS, echo_model).write(str(tmp_path / "b"))
    assert none.groups == {"rows": 0, "cases": 0, "reduction": 0, "reduction_pct": None}
    assert none.formats == {} and none.merge["coverage_pct"] is None


def dies_at(log, path, n):
    """A model that writes down what it is asked, and kills its worker at the n-th case
    unless the file at ``path`` says that it was cured."""
    def model(prompts):
        for _, user in prompts:
            with open(log, "a") as f:
                f.write(user + "\n")
        if not os.path.exists(path) and sum(1 for _ in open(log)) >= n:
            os._exit(1)
        return echo_model(prompts)

    return model


def many(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("h"), F.col("id").cast("string")).alias("id"), F.lit("k").alias("obs_key"),
        F.concat(F.lit("caso numero "), F.col("id").cast("string"), F.lit(" en la calle")).alias("observacion"))


def test_a_run_that_died_asks_for_nothing_twice(spark, tmp_path):
    log, cured = str(tmp_path / "asked"), str(tmp_path / "cured")
    store = durable.AnswerLog(str(tmp_path / "answers"), "r1")
    asked = dict(batch_size=10, wave_batches=2, parallelism=1, call_size=5)

    def run():
        return durable.classify_in_waves(many(spark, 100), Prompts("s"), dies_at(log, cured, 70), store, ["id", "obs_key"], **asked)

    with pytest.raises(Exception):
        run()
    committed = {r["case_key"] for r in store.answers(spark).collect()}
    assert store.waves(spark) == [1, 2, 3] and len(committed) == 60
    before = open(log).read().splitlines()
    open(cured, "w").close()
    done = run()
    assert done.count() == done.select("id").distinct().count() == 100
    later = open(log).read().splitlines()[len(before):]
    assert len(later) == 40 and len(set(later)) == 40
    assert len(set(before[:60]) & set(later)) == 0  # three waves of 20
    assert store.waves(spark) == [1, 2, 3, 4, 5]
    assert [tuple(r) for r in store.commits(spark).orderBy("wave").collect()] == [(w, 2, 20, 0) for w in range(1, 6)]
    # a third start has nothing to ask, a new case is asked alone
    run().count()
    assert len(open(log).read().splitlines()) == len(before) + 40
    more = durable.classify_in_waves(many(spark, 101), Prompts("s"), dies_at(log, cured, 70), store, ["id", "obs_key"], **asked)
    assert more.count() == 101
    assert open(log).read().splitlines()[len(before) + 40:] == ["caso numero 100 en la calle"]


def test_written_but_not_committed_is_asked_again(spark, tmp_path):
    store = durable.AnswerLog(str(tmp_path / "answers"), "r1")
    rest = spark.createDataFrame([("x", "stale", None, "t", 1)], "case_key string, raw_response string, call_error string, timestamp string, batch_id long")
    rest.write.parquet(store._path("answers/000001"))
    assert store.answers(spark).count() == 0
    got = durable.classify_in_waves(many(spark, 5), Prompts("s"), echo_model, store, ["id", "obs_key"])
    assert got.count() == 5 and store.answers(spark).filter("raw_response = 'stale'").count() == 0


def test_errors_are_answers_unless_asked_again(spark, tmp_path):
    store = durable.AnswerLog(str(tmp_path / "answers"), "r 1")
    rows = [("a", None), ("a", None), (None, "b"), ("c", "d")]
    df = spark.createDataFrame(rows, "id string, obs_key string").withColumn("observacion", F.coalesce("id", F.lit("none")))
    key = ["id", "obs_key"]

    def fails(prompts):
        return [RuntimeError("no") if u == "c" else "first" for _, u in prompts]

    def well(prompts):
        return ["second" for _ in prompts]

    def said(df):
        return sorted((r.id or "", r.obs_key or "", r.raw_response or r.call_error) for r in df.collect())

    first = durable.classify_in_waves(df, Prompts("s"), fails, store, key)
    assert said(first) == [("", "b", "first"), ("a", "", "first"), ("a", "", "first"), ("c", "d", "no")]
    assert said(durable.classify_in_waves(df, Prompts("s"), well, store, key))[3] == ("c", "d", "no")
    again = durable.classify_in_waves(df, Prompts("s"), well, store, key, again_after_errors=True)
    assert said(again) == [("", "b", "first"), ("a", "", "first"), ("a", "", "first"), ("c", "d", "second")]
    empty = durable.classify_in_waves(df.limit(0), Prompts("s"), well, durable.AnswerLog(store.folder, "r2"), key)
    assert empty.count() == 0


def test_a_whole_run_goes_on(spark, tmp_path):
    log, cured = str(tmp_path / "asked"), str(tmp_path / "cured")
    given = dict(run_id="week 1", answers=str(tmp_path / "answers"), wave_batches=1)
    options = SurveyOptions(result_key="id_text", batch_size=1)
    with pytest.raises(Exception):
        run_review(raw(spark), options, I.PROMPTS, dies_at(log, cured, 3), **given)
    open(cured, "w").close()
    run = run_review(raw(spark), options, I.PROMPTS, dies_at(log, cured, 3), **given)
    assert states(run) == states(run_review(raw(spark), options, I.PROMPTS, echo_model))
    assert run.run_id == "week 1" and open(log).read().count("Report:") == 4


def test_run_with_a_hot_household(spark):
    """A third of all rows in one household, and as many under one row id."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("HOGAR"),
        F.lit(1).alias("P201"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(1).alias("ID"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 900).alias("P424_ID"),
        F.when(F.col("id") % 2 == 0, NARRATIVES[0]).otherwise(NARRATIVES[1]).alias("OBS_400A"),
    )
    plain = run_review(rows, SurveyOptions(result_key="id_text"), I.PROMPTS, echo_model)
    spread = run_review(
        rows, SurveyOptions(result_key="id_text", hot_key_rows=20), I.PROMPTS, echo_model
    )
    assert "__salts" in plan(spread.merged)
    a, b = plain.merged, spread.merged
    assert a.count() == b.count() >= 3000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_every_query_has_its_sql():
    import __spark_entry__ as entry

    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own == set(QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLES)
    assert set(entry.LLM_ORACLES) <= set(entry.LLM_QUERIES)


PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["text_clean", "group_obs", "chat_read", "prefix_rank", "parse_response",
                                  "dedup_last", "review_complex", "merge_complex", "attempt_similarity"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(n in text for n in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    rows = text.splitlines()
    gathered = [i for i, row in enumerate(rows) if "Exchange SinglePartition" in row]
    assert all("functions=[partial_" in rows[i + 1] for i in gathered)  # one row per task


def test_rank_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["prefix_rank"](spark, SF))
    assert "WindowGroupLimit" in plan(QUERIES["format_examples"](spark, SF))


def test_text_is_cleaned_once_per_row(spark):
    o = I.OPTIONS
    keyed = prepare.with_keys(I.survey(spark, SF), o)
    df = prepare.valid_rows(prepare.with_clean_text(keyed, o), o).select(prepare.CLEAN)
    assert plan(df).count("ALTERNATIVA") == 1


def test_scan_reads_needed_columns(spark):
    text = plan(QUERIES["key_build"](spark, SF))
    assert "l_shipdate" not in text and "l_orderkey" in text

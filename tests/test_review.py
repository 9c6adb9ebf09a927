import pytest
from pyspark.sql import functions as F

from surveyqc.operators import consistency, merge, review
from surveyqc.operators.skew import heavy_hitters, salted_join

UNNESTED = (
    "id_delito_ia string, id_observacion string, observacion string, expected_codes_obs array<string>, "
    "predicted_codes_obs array<string>, razonamiento_general_modelo string, "
    "predicciones_detalladas_modelo map<string,string>"
)


def fn(code):
    return f"FN: El código esperado '{code}' no fue detectado."


def fp(code, why="TRUNCADA/NO DISPONIBLE"):
    return f"Código FP: {code} | Justificación: {why}"


# expected, predicted, row code, details → match, state, justification, detail
CASES = [
    (["9"], ["9"], "9", {"9": "j"}, (True, 1, "j", None)),
    (["9"], ["9"], "9", {}, (True, 1, "Justificación TRUNCADA/NO DISPONIBLE", None)),
    (["9"], ["9"], "9", {"9": None}, (True, 1, None, None)),
    (["9"], ["9", "30"], "9", {"9": "j", "30": "k"}, (True, 1, "j", fp("30", "k"))),
    (["9"], ["9", "4", "30", "4"], "9", {"4": None}, (True, 1, "Justificación TRUNCADA/NO DISPONIBLE",
                                                   fp("30") + "\n" + fp("4", "None"))),
    (["9", "2"], ["9", "30"], "9", {"9": "j"}, (True, 1, "j", None)),
    (["9", "2"], ["9", "30"], "2", {}, (False, 3, None, fp("30") + "\n---\n" + fn("2"))),
    (["9"], ["23"], "9", {"23": "b"}, (False, 2, None, fp("23", "b") + "\n---\n" + fn("9"))),
    (["9"], [], "9", {}, (False, 5, None,
     "ERROR: El modelo no detectó ningún delito. Se esperaba el código '9' Revisar justificación.")),
    (["9"], ["9"], None, {}, (False, 2, None, fn("None"))),
    (["9"], [], None, {}, (False, 5, None, fn("None"))),
]


def reviewed(spark):
    rows = [
        (None if d is None else f"{i}-1-{d}", str(i), "o", e, p, "1. A. 5. Construyo el JSON final", m)
        for i, (e, p, d, m, _) in enumerate(CASES)
    ]
    rows.append(("x-1-1", None, "o", [], [], "r", {}))
    return review.review_complex(spark.createDataFrame(rows, UNNESTED).repartition(1))


def test_review_cases(spark):
    got = reviewed(spark).collect()
    assert len(got) == len(CASES)
    for r, (*_, d, _, wanted) in zip(got, CASES):
        assert (r.MATCH_DELITO, r.ESTADO_REVISION, r.JUSTIFICACION_ACIERTO,
                r.DETALLE_ERRORES_MODELO) == wanted
        assert r.DELITO_ESPERADO == d and r.RAZONAMIENTO_GENERAL == "1. A."


def test_column_order_and_stats(spark):
    r = reviewed(spark)
    assert r.columns == review.COMPLEX_COLUMNS
    s = review.review_stats(r).first()
    assert (s.total_records, s.matches, s.false_negatives) == (11, 6, 5)
    assert s.match_rate == pytest.approx(600 / 11)
    s = review.review_stats(r.limit(0)).first()
    assert (s.total_records, s.match_rate) == (0, 0.0)


def test_simple_review(spark):
    df = spark.createDataFrame(
        [("a", "a", "o", [], ["9", "10"], "r ", {}), ("b", "b", "o", [], [], None, {})], UNNESTED
    )
    r = review.review_simple(df)
    assert [tuple(x) for x in r.orderBy("ID_DELITO_IA").collect()] == [
        ("a", "o", "9, 10", "r"), ("b", "o", "Ninguno", None),
    ]
    assert review.review_stats(r).first().matches is None


REVIEW = ("ID_DELITO_IA string, MATCH_DELITO boolean, ESTADO_REVISION int, JUSTIFICACION_ACIERTO string, "
          "DETALLE_ERRORES_MODELO string, RAZONAMIENTO_GENERAL string")


def test_merge_upsert_fan_out_and_stats(spark):
    original = spark.createDataFrame(
        [(1, "a", "viejo"), (2, "a", "viejo"), (3, "b", "viejo"), (4, None, "viejo"), (5, "c", None)],
        "n int, ID_DELITO_IA string, RAZONAMIENTO_GENERAL string",
    )
    rev = spark.createDataFrame(
        [("a", True, 1, "j", None, "nuevo"), ("b", False, 2, None, "d", None),
         ("b", False, 3, None, "e", "otro"), ("zz", True, 1, None, None, None)], REVIEW
    )
    m = merge.merge_review(original, rev)
    got = sorted((r.n, r.MATCH_DELITO, r.ESTADO_REVISION, r.RAZONAMIENTO_GENERAL) for r in m.collect())
    assert got == [(1, True, 1, "nuevo"), (2, True, 1, "nuevo"), (3, False, 2, "viejo"),
                   (3, False, 3, "otro"), (4, None, 4, "viejo"), (5, None, 4, None)]
    labels = {r.n: (r.match_label, r.match_color) for r in merge.with_match_label(m).collect()}
    assert labels[1] == ("true", "C6EFCE") and labels[3] == ("false", "FFC7CE")
    assert labels[4] == ("FALTA OBS.", "D3D3D3")
    s = merge.merge_stats(m, rev, original).first()
    assert (s.total_rows, s.analysis_total, s.records_with_analysis, s.successful_matches,
            s.missing_in_original) == (6, 4, 4, 2, 1)
    assert (s.match_rate, s.analysis_coverage) == (50.0, 75.0)
    other = merge.merge_review(original, rev.withColumnRenamed("ID_DELITO_IA", "K"), review_key="K")
    assert "K" not in other.columns and other.count() == 6


def test_merge_simple(spark):
    original = spark.createDataFrame(
        [("1",), ("1.0",), (" 2 ",), ("9",), (None,)], "ID string"
    )
    rev = spark.createDataFrame(
        [("1", "a", 1), ("1.00", "b", 2), ("2", "c", 1)],
        "ID_DELITO_IA string, RAZONAMIENTO_GENERAL string, seq int",
    )
    got = {r.ID: r.RAZONAMIENTO_GENERAL for r in merge.merge_simple(original, rev, "ID", ["seq"]).collect()}
    assert got == {"1": "b", "1.0": "b", " 2 ": "c", "9": "", None: None}


def test_salted_join_equals_plain_join(spark):
    """One key with a third of all rows, duplicates on the right, null keys."""
    left = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, None)
        .otherwise(F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    right = spark.range(1200).select((F.col("id") % 400).alias("k"), F.col("id").alias("w"))
    for how in ("inner", "left"):
        a = salted_join(left, right, ["k"], how, min_rows=50)
        b = left.join(right, ["k"], how)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hot = heavy_hitters(left, ["k"], 8, 50)
    one = spark.range(1).select(F.xxhash64(F.lit(1).cast("long"))).first()[0]
    assert hot == {one: 3}
    assert "__salts" in salted_join(left, right, ["k"], "left", min_rows=50)._jdf.queryExecution().toString()
    # the right side's key of another type takes the same salts
    narrow = right.withColumn("k", F.col("k").cast("int"))
    assert salted_join(left, narrow, ["k"], min_rows=50).count() == left.join(right, ["k"]).count()
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], at_least=2, min_rows=50)
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], "full")


def test_heavy_hitters_shuffle_no_keys(spark):
    """All keys above two shares are found among half a million; what leaves a task is one
    sketch."""
    k = F.col("id")
    df = spark.range(600_000, numPartitions=6).select(
        F.when(k % 6 == 0, 5).when(k % 6 == 1, k % 3000).when(k % 60 == 2, None).otherwise(k).alias("k"))
    counts = {r["h"]: r["n"] for r in df.dropna().groupBy(F.xxhash64("k").alias("h")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    for parts in (4, 64, 512):
        hot = heavy_hitters(df, ["k"], parts, 1)
        share = 600_000 / parts
        assert {h for h, n in counts.items() if n > 2 * share} <= set(hot)
        assert all(counts[h] > 0.8 * share and n <= counts[h] / share * 1.2 + 1 for h, n in hot.items())
        assert len(hot) < 2 * parts
    assert heavy_hitters(df.limit(0), ["k"], 8, 1) == {}
    assert heavy_hitters(df.filter("k is null"), ["k"], 8, 1) == {}


ATTEMPTS = [
    ("same", [["9"], ["9"]], 100.0, "PERFECTA"),
    ("half", [["9", "2"], ["9"]], 50.0, "MEDIA"),
    ("none", [["9"], ["2"]], 0.0, "BAJA"),
    ("empty", [[], []], 100.0, "PERFECTA"),
    ("one_failed", [["9"], None], 100.0, "PERFECTA"),
    ("all_failed", [None, None], 0.0, "BAJA"),
    ("single", [None], 100.0, "PERFECTA"),
    ("high", [["1", "2", "3", "4", "5"], ["1", "2", "3", "4"]], 80.0, "ALTA"),
    ("repeated", [["9", "9"], ["9"]], 100.0, "PERFECTA"),
]


def test_attempt_similarity(spark):
    rows = [(name, i, c) for name, tries, *_ in ATTEMPTS for i, c in enumerate(tries)]
    df = spark.createDataFrame(rows, "obs_id string, attempt int, codes array<string>")
    got = {r.obs_id: r for r in consistency.attempt_similarity(df).collect()}
    for name, tries, similarity, tier in ATTEMPTS:
        assert (got[name].similarity, got[name].tier) == (similarity, tier), name
        assert got[name].n_attempts == len(tries)
    assert (got["half"].common_codes, got["half"].all_codes) == (["9"], ["2", "9"])
    codes = {(r.obs_id, r.code): (r.freq, r.pct, r.tier) for r in consistency.attempt_codes(df).collect()}
    assert codes[("half", "9")] == (2, 100.0, "CONSISTENTE")
    assert codes[("half", "2")] == (1, 50.0, "PARCIAL")
    assert codes[("one_failed", "9")] == (1, 50.0, "PARCIAL")
    assert codes[("repeated", "9")][0] == 2


def test_rare_code_is_inconsistent(spark):
    df = spark.createDataFrame(
        [("o", i, ["9"] if i == 0 else []) for i in range(3)],
        "obs_id string, attempt int, codes array<string>",
    )
    assert [r.tier for r in consistency.attempt_codes(df).collect()] == ["INCONSISTENTE"]

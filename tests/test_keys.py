import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from surveyqc.functions import keys as K
from surveyqc.operators import prepare
from surveyqc.options import SurveyOptions, check_columns

ROWS = [
    (("1", "2", "3", "9"), "1-2-3-9", "1-2-3"),
    (("1.0", "2", "3", None), "1-2-3-NULO", "1-2-3"),
    (("007", "2", "x", "9"), "7-2-NULO-9", "7-2-NULO"),
    (("1", "2", "3", "-5"), "1-2-3--5", "1-2-3-"),
    (("9007199254740993", " 2 ", "3e2", "1d"), "9007199254740993-2-300-NULO", "9007199254740993-2-300"),
    (("NaN", "Infinity", "", "."), "NULO-NULO-NULO-NULO", "NULO-NULO-NULO"),
]


def test_row_and_base_key(spark):
    df = spark.createDataFrame([r[0] for r in ROWS], "a string, b string, c string, d string")
    key = K.row_key(df, "abcd")
    got = df.select(key.alias("k")).withColumn("b", K.base_key(F.col("k"))).collect()
    assert {(r.k, r.b) for r in got} == {(r[1], r[2]) for r in ROWS}


def test_doubles_and_integers(spark):
    df = spark.createDataFrame([(1, 2.0), (None, None), (2, float("nan"))], "a bigint, b double")
    got = [r[0] for r in df.select(K.row_key(df, ["a", "b"])).collect()]
    assert sorted(got) == ["1-2", "2-NULO", "NULO-NULO"]


def test_fraction_raises_or_is_missing(spark):
    df = spark.createDataFrame([("1.5",)], "a string")
    number = df.select(F.col("a").cast("double"))
    for d in (df, number):
        kind = d.schema["a"].dataType
        with pytest.raises(Exception, match="not a whole number"):
            d.select(K.integer_part(F.col("a"), kind)).collect()
        assert d.select(K.integer_part(F.col("a"), kind, "null")).first()[0] is None


def test_code_text(one):
    got = one(lambda c: K.code_text(c, StringType()), ["9", "9.7", " 10 ", "x", None, "-3.2", "1e3"])
    assert got == ["9", "9", "10", None, None, "-3", "1000"]


def test_last_part(one):
    assert one(K.last_part, ["1-2-3-9", "1-2-3--5", "x", None]) == ["9", "5", "x", None]


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "t")], "ID int, OBS string")
    with pytest.raises(ValueError, match="DESCRIPCION1"):
        check_columns(df, SurveyOptions.simple().required_columns)
    with pytest.raises(ValueError):
        prepare.with_keys(df, SurveyOptions())


def test_options_are_checked():
    for bad in ({"mode": "x"}, {"pattern_min_percent": 0}, {"code_col": None}, {"batch_size": 0},
                {"on_fractional": "x"}, {"result_key": "x"}):
        with pytest.raises(ValueError):
            SurveyOptions(**bad)


NARRATIVE = "le robaron el celular en la calle"
OTHER = "entraron a la casa por la ventana"


def survey(spark):
    rows = [
        (1, 1, 1, 9.0, NARRATIVE), (1, 1, 1, 9.0, NARRATIVE), (1, 1, 1, 10.0, NARRATIVE + "  "),
        (1, 1, 1, None, NARRATIVE), (1, 1, 1, 2.0, OTHER), (2, 1, 1, 4.0, "corto"),
        (3, 1, 1, 5.0, None),
    ]
    return spark.createDataFrame(rows, "HOGAR int, P201 int, ID int, P424_ID double, OBS_400A string")


def valid(spark):
    o = SurveyOptions()
    return prepare.valid_rows(prepare.with_clean_text(prepare.with_keys(survey(spark), o), o), o)


def test_groups(spark):
    o = SurveyOptions()
    got = {r[prepare.CLEAN]: r for r in prepare.group_observations(valid(spark), o).collect()}
    assert got[NARRATIVE][prepare.CODES] == ["10", "9"]
    assert got[NARRATIVE][prepare.ROW_IDS] == ["1-1-1-10", "1-1-1-9", "1-1-1-NULO"]
    assert got[OTHER][prepare.ROW_IDS] == ["1-1-1-2"]
    members = prepare.group_members(valid(spark)).collect()
    assert sorted(r[prepare.ROW_ID] for r in members) == [
        "1-1-1-10", "1-1-1-2", "1-1-1-9", "1-1-1-NULO",
    ]


def test_group_reports(spark):
    o = SurveyOptions()
    v = valid(spark)
    stats = prepare.group_stats(v, prepare.group_codes(v, o)).first()
    assert (stats.filas_antes, stats.filas_despues, stats.reduccion) == (5, 2, 3)
    assert stats.reduccion_pct == pytest.approx(60.0)
    assert [tuple(r) for r in prepare.inconsistent_keys(v).collect()] == [("1-1-1", 2)]
    assert prepare.group_example(v, o).count() == 5
    rejected = prepare.rejected_rows(
        prepare.with_clean_text(prepare.with_keys(survey(spark), o), o), o
    ).collect()
    assert {(r.id_delito_ia, r.observacion_original) for r in rejected} == {
        ("2-1-1-4", "corto"), ("3-1-1-5", None),
    }


def test_empty_table(spark):
    o = SurveyOptions()
    v = valid(spark).limit(0)
    stats = prepare.group_stats(v, prepare.group_codes(v, o)).first()
    assert (stats.filas_antes, stats.reduccion_pct) == (0, None)
    assert prepare.group_example(v, o).count() == 0


def test_simple_mode(spark):
    df = spark.createDataFrame(
        [("a", NARRATIVE, "7.0"), ("b", NARRATIVE, None), ("c", NARRATIVE, "x")],
        "ID string, DESCRIPCION1 string, COD string",
    )
    o = SurveyOptions.simple(code_col="COD")
    rows = prepare.with_clean_text(prepare.with_keys(df, o), o)
    got = {r[0]: (r[2], r[3]) for r in prepare.group_observations(rows, o).collect()}
    assert got == {"a": (["7"], ["a"]), "b": ([], ["b"]), "c": ([], ["c"])}
    o = SurveyOptions.simple()
    got = prepare.group_observations(prepare.with_clean_text(prepare.with_keys(df, o), o), o)
    assert {tuple(r[2]) for r in got.collect()} == {()}


def test_ids_of_floats_are_written_out(spark):
    values = [12345678.0, 1234.0, -5.0, 0.5, None, 1e15]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r.t for r in df.select("i", K.id_text(F.col("x"), df.schema["x"].dataType).alias("t")).orderBy("i").collect()]
    assert got == ["12345678.0", "1234.0", "-5.0", "0.5", None, "1000000000000000.0"]


def test_simple_merge_finds_numbers_in_any_notation(spark):
    from surveyqc.operators.merge import merge_simple

    review = spark.createDataFrame([("12345678", "a"), ("7", "b"), ("5", "c")], "ID_DELITO_IA string, RAZONAMIENTO_GENERAL string")
    floats = spark.createDataFrame([(12345678.0,), (7.0,), (8.0,), (None,)], "id double")
    got = {r.id: r.RAZONAMIENTO_GENERAL for r in merge_simple(floats, review, "id").collect()}
    assert got == {12345678.0: "a", 7.0: "b", 8.0: "", None: None}
    texts = spark.createDataFrame([("007",), ("+5",), ("x",)], "id string")
    assert {r.id: r.RAZONAMIENTO_GENERAL for r in merge_simple(texts, review, "id").collect()} == {"007": "b", "+5": "c", "x": ""}

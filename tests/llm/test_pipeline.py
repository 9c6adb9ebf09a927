import corpus_pipeline
from surveyqc.llm.common import table
from surveyqc.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    """Each stage keeps the columns, keeps clean rows, and does what its query says."""
    docs = table(spark, SF, "documents").cache()
    first = {r.doc_id: r.kept for r in QUERIES["op3_quality_rules"](spark, SF).collect()}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF).cache()
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        before, after = ({r.doc_id: r.text for r in df.collect()} for df in (seen, out))
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert set(after) == {i for i in before if first[i]}
        if name in ("decontaminate", "personal_data"):
            assert set(after) == set(before)
        if name == "personal_data":
            assert not any("@mail" in t for t in after.values()) and any("[EMAIL]" in t for t in after.values())
        seen = out
    last = corpus_pipeline.STAGES[-1][1](spark, seen, SF)
    assert last.count() == seen.count()


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    """Also of rows that repeat id and text, and of copies without an id."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [
        (1, a), (1, a), (2, a), (None, a), (None, b), (None, b), (None, c), (3, ""), (3, ""), (None, None), (None, None),
        (4, d), (4, e), (5, a + " z"), (None, b + " z"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.dtypes == docs.dtypes
    got = [(r.doc_id, r.text) for r in out.collect()]
    near = [t for i, t in got if i is None and t and t.startswith("b0")]
    assert len(near) == 1
    rest = [r for r in got if r[1] not in near]
    assert sorted(rest, key=str) == sorted([(1, a), (None, c), (3, ""), (None, None), (4, d), (4, e)], key=str)

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from surveyqc.operators import chat, prepare, reconcile
from surveyqc.operators.prepare import BASE_ID, CLEAN, CODES, OBS_KEY, ROW_ID, ROW_IDS
from surveyqc.sources import files


def loaded(spark, lines):
    rows = [("f", i, v) for i, v in enumerate(lines)]
    return reconcile.load_records(spark.createDataFrame(rows, "file string, pos int, value string"))


def test_ids_and_status(spark):
    cases = {
        '{"id":"a"}': ("ok", "a"),
        '{"id":7}': ("ok", "7"),
        '{"id":null,"case_id":"a"}': ("no_id", None),
        '{"id":"","case_id":"a"}': ("no_id", None),
        '{"id":0}': ("no_id", None),
        '{"case_id":"b"}': ("ok", "b"),
        '{"id_observacion":"c"}': ("ok", "c"),
        '{"x":1}': ("no_id", None),
        '{"id":"a"': ("bad_json", None),
        '{"id":"a"} x': ("bad_json", None),
        "": ("bad_json", None),
        "[1]": ("no_id", None),
        "17": ("other_error", None),
        "null": ("other_error", None),
        '"x"': ("no_id", None),
        '"id"': ("other_error", None),
    }
    got = [(r.status, r.id) for r in loaded(spark, list(cases)).orderBy("pos").collect()]
    assert got == list(cases.values())
    audit = {r.status: r.n for r in reconcile.load_audit(loaded(spark, list(cases))).collect()}
    assert audit == {"ok": 4, "no_id": 6, "bad_json": 3, "other_error": 3}
    bad = reconcile.unreadable_lines(loaded(spark, ["x" * 300])).first()
    assert (bad.file, bad.pos, bad.contenido_parcial) == ("f", 0, "x" * 100)


def test_files_in_path_order_last_wins(spark, tmp_path):
    def put(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")

    put("resultados_lote_2_x.jsonl", '{"id":"a","observacion":"de dos"}', '{"id":"b","observacion":"ñ 1"}',
        '{"id":"b","observacion":"ñ 2"}', "{bad")
    put("resultados_lote_10_x.jsonl", '{"id":"a","observacion":"de diez"}')
    put("lote_9.jsonl", '{"id":"z"}')
    (tmp_path / "resultados_lote_backup").mkdir()
    (tmp_path / "resultados_lote_backup" / "resultados_lote_1.jsonl").write_text('{"id":"q"}\n')
    lines = files.read_batches(spark, str(tmp_path))
    records = reconcile.records_of(reconcile.load_records(lines))
    got = {r.id: r.observacion for r in reconcile.last_wins(records, ["id"], ["file", "pos"]).collect()}
    assert got == {"a": "de dos", "b": "ñ 2"}


def test_last_wins_by_place(spark):
    """One id, or a null one, in a third of all rows: the winner is that of the wide sort."""
    n = 3000
    rows = spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise((F.col("id") % 500).cast("string")).alias("id"),
        (F.xxhash64("id") % 5).alias("file"), F.col("id").alias("pos"),
        F.repeat(F.lit("x"), 300).alias("observacion"),
    )
    wide = reconcile.last_wins(rows, ["id"], ["file", "pos"])
    narrow = reconcile.last_wins(rows, ["id"], ["file", "pos"], place=["file", "pos"])
    assert narrow.columns == rows.columns
    key = lambda r: (r.id or "", r.file, r.pos)
    assert sorted(map(key, narrow.collect())) == sorted(map(key, wide.collect()))
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "max_by" not in plan
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert not any("observacion" in line for line in aggregates)
    assert reconcile.last_wins(rows.limit(0), ["id"], ["pos"], place=["pos"]).count() == 0


def test_batch_folder_patterns(spark, tmp_path):
    import pytest

    with pytest.raises(FileNotFoundError):
        files.read_batches(spark, str(tmp_path))
    (tmp_path / "batch_1.jsonl").write_text('{"id":"a"}\n')
    assert files.read_batches(spark, str(tmp_path)).count() == 1


def test_latin1_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_bytes('{"id":"ñandú"}\n'.encode("latin-1"))
    lines = files.read_lines(spark, str(tmp_path), "ISO-8859-1")
    assert reconcile.load_records(lines).first().id == "ñandú"


def test_runs_side_by_side(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = spark.createDataFrame([("a", 1), ("b", 2)], "id string, batch_id int")
    files.write_run(one, path, "20250101")
    files.write_run(one.filter("id = 'b'"), path, "20250102")
    assert [r.id for r in files.read_latest_run(spark, path).collect()] == ["b"]
    files.write_run(one.filter("id = 'a'"), path, "9")
    files.write_run(one, path, "10")
    last = files.read_latest_run(spark, path)
    assert [r.id for r in last.collect()] == ["a"] and last.columns == one.columns
    assert sorted(p.name for p in Path(path).iterdir() if p.is_dir()) == [
        "_log", "run_id=10", "run_id=20250101", "run_id=20250102", "run_id=9"]
    assert spark.read.parquet(path).count() == 6
    # an unfinished run is never read, and its rest is replaced
    one.write.parquet(f"{path}/run_id=99")
    assert files.read_latest_run(spark, path).count() == 1
    files.write_run(one.filter("id = 'b'"), path, "99")
    assert [r.id for r in files.read_latest_run(spark, path).collect()] == ["b"]
    assert all("run_id=99" in f for f in files.read_latest_run(spark, path).inputFiles())
    for bad in ("99", "", "a/b"):
        with pytest.raises(ValueError):
            files.write_run(one, path, bad)
    with pytest.raises(FileNotFoundError):
        files.read_latest_run(spark, str(tmp_path / "none"))


def test_problem_sink(spark, tmp_path):
    path = str(tmp_path / "p")
    files.write_problem_cases(spark.createDataFrame([("a", "C")], "id string, format_class string"), path)
    assert [d.name for d in (tmp_path / "p").iterdir() if d.is_dir()] == ["format_class=C"]
    files.write_lines(spark.createDataFrame([("ñ",)], "t string"), str(tmp_path / "l"))
    text = "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "l").glob("*.json"))
    assert "ñ" in text


def test_chat_round_trip_and_damage(spark, tmp_path):
    groups = spark.createDataFrame(
        [("1-1", 'texto "ñ"', ["9", "10"], ["1-1-9", "1-1-10"]), ("2-1", "x", [], ["2-1-NULO"])],
        f"{BASE_ID} string, {CLEAN} string, {CODES} array<string>, {ROW_IDS} array<string>",
    )
    path = str(tmp_path / "chat")
    chat.chat_lines(chat.build_chat(groups)).write.text(path)
    more = ['{"id":"z","messages":[{"role":"system","content":"s"},{"role":"user","content":"u"}]}',
            '{"id":"y","messages":[{"content":"s"},{"content":"u"},{"content":"{bad"}]}',
            '{"id":"x","messages":"no"}', "{", "3",
            '{"id":"w","messages":[{"content":"s"},{"content":"u"},{"content":"{}"}]}']
    lines = files.read_lines(spark, path).select("value").union(
        spark.createDataFrame([(m,) for m in more], "value string")
    )
    cases = {r.id: (r.observacion, r.expected_codes, r[ROW_IDS])
             for r in chat.cases_from_chat(chat.read_chat(lines)).collect()}
    assert cases == {
        "1-1": ('texto "ñ"', ["10", "9"], ["1-1-9", "1-1-10"]),
        "2-1": ("x", [], ["2-1-NULO"]), "w": ("u", [], []),
    }
    ids = {r.id: r[ROW_IDS] for r in chat.reference_from_chat(chat.read_chat(lines, 2)).collect()}
    assert ids["z"] == [] and ids["y"] == [] and ids["1-1"] == ["1-1-9", "1-1-10"]
    shouted = chat.replace_user_text(chat.read_chat(lines), F.upper)
    assert {r.messages[1].content for r in shouted.collect()} == {'TEXTO "Ñ"', "X", "U"}


def record(i, raw="", codes=()):
    return (i, "t" + i, ["9"], list(codes), "r", raw, "2025", None)


RECORD = ("id string, observacion string, expected_codes array<string>, predicted_codes array<string>, "
          "razonamiento_modelo string, raw_response string, timestamp string, error boolean")
RAW = '{"razonamiento":"r","clasificaciones":[{"codigo":"9","justificacion":"j"}]}'


def test_unnest_and_issues(spark):
    records = spark.createDataFrame(
        [record("a", RAW, ["9"]), record("b", RAW, ["9", "2"]), record("c"), record("gone")], RECORD
    )
    reference = spark.createDataFrame(
        [("a", ["a-9", "a-10"]), ("b", []), ("c", None), ("new", ["n-1"])],
        f"id string, {ROW_IDS} array<string>",
    )
    detailed = reconcile.with_details(records)
    rows = reconcile.unnest(detailed, reference)
    assert sorted((r.id_observacion, r.id_delito_ia or "") for r in rows.collect()) == [
        ("a", "a-10"), ("a", "a-9"), ("b", ""), ("c", ""),
    ]
    assert all(r.processing_error is False for r in rows.collect())
    assert reconcile.unnest_simple(detailed, reference).count() == 3
    issues = reconcile.parse_issues(detailed)
    assert [tuple(r) for r in issues.collect()] == [("b", ["2", "9"], ["9"])]
    assert [r.id for r in reconcile.missing_ids(reference, records).collect()] == ["new"]
    assert [r.id for r in reconcile.missing_ids(records, reference).collect()] == ["gone"]
    summary = reconcile.recon_summary(records, reference, rows, issues).first()
    assert tuple(summary) == (4, 4, 4, 4, 1)


def test_hot_group_members(spark):
    """A third of all rows in one group: same rows with and without salting."""
    n = 3000
    members = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias(BASE_ID),
        F.lit("k").alias(OBS_KEY),
        F.concat(F.lit("row-"), F.col("id")).alias(ROW_ID),
    )
    ids = ["hot"] + [f"g{i}" for i in range(50)]
    records = spark.createDataFrame([record(i, RAW, ["9"]) for i in ids], RECORD)
    detailed = reconcile.with_details(records).withColumn(OBS_KEY, F.lit("k"))
    plain = reconcile.unnest_members(detailed, members)
    salted = reconcile.unnest_members(detailed, members, min_rows=100)
    assert plain.count() == salted.count() == n
    assert salted.select("id_delito_ia").distinct().count() == n
    assert salted.filter("id_observacion = 'hot'").count() == 1000


def test_group_identity_is_exact(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x "), ("a", "x")], f"{BASE_ID} string, {CLEAN} string")
    assert prepare.with_obs_key(df).select(OBS_KEY).distinct().count() == 2


def test_line_numbers_over_many_splits(spark, tmp_path):
    """Two files cut into many splits, with empty lines; numbers as an editor shows them."""
    import json
    import random

    rng = random.Random(1)
    broken = ['{"id":"1"', "{'a':1}", "nothing", '{"a":"x', '{"a":1,"a":2}', '[1,2', '{"id":NaN}', "{}x", "ñ{"]
    want = {}
    for name in ("resultados_lote_1.jsonl", "resultados_lote_2.jsonl"):
        rows = [rng.choice([*broken, "", '{"id":"%d","observacion":"%s"}' % (k, "ñ" * rng.randint(0, 40))]) for k in range(3000)]
        (tmp_path / name).write_text("".join(r + "\n" for r in rows), encoding="utf-8")
        for number, row in enumerate(rows, 1):
            try:
                json.loads(row)
                if row in ('{"a":1,"a":2}', '{"id":NaN}'):
                    want[name, number] = (row, "repeated key, or a number that JSON does not have")
            except ValueError:
                try:
                    json.loads(row + "\n")
                except ValueError as e:
                    want[name, number] = (row, str(e)[:100])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        lines = files.read_batches(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 8
        got = reconcile.reading_errors(reconcile.load_records(lines), lines).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {(r["file"].rsplit("/", 1)[1], r["linea"]): (r["contenido_parcial"], r["error"]) for r in got} == want
    assert len(got) == len(want) and {r["format_name"] for r in got} == {"Error de Lectura"}


def test_a_file_in_parts_has_the_line_numbers_of_one(spark, tmp_path):
    rest = ',"observacion":"' + "una casa " * 9 + '"'
    texts = [(f"f{i % 3}", f'{{"id":"{i % 700:04d}-{i}"{rest}' + ("}" if i % 5 else "")) for i in range(3000)]
    rows = spark.createDataFrame(texts, "file string, value string").repartition(7)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # as for tables that need not be coalesced
    spark.conf.set(setting, "false")
    try:
        files.write_line_parts(rows, f"{tmp_path}/lines")
    finally:
        spark.conf.unset(setting)
    parts = {d.name: [p.stat().st_size for p in d.glob("part-*")] for d in (tmp_path / "lines").glob("file=*")}
    assert sorted(parts) == ["file=f0", "file=f1", "file=f2"] and max(map(len, parts.values())) > 1
    assert sum(map(sum, parts.values())) < sum(len(t) + 1 for _, t in texts) / 2
    lines = files.read_lines(spark, f"{tmp_path}/lines/*", parts=True)
    got = {(r["file"].rsplit("=")[1], r["linea"], r["value"])
           for r in files.with_line_numbers(lines, lines).select("file", "linea", "value").collect()}
    want = {(f, n, t) for f in ("f0", "f1", "f2") for n, t in enumerate(sorted(t for g, t in texts if g == f), 1)}
    assert got == want
    bad = reconcile.reading_errors(reconcile.load_records(lines), lines).collect()
    assert len(bad) == 600 and {(r["file"].rsplit("=")[1], r["linea"], r["contenido_parcial"]) for r in bad} <= {(f, n, t[:100]) for f, n, t in want}

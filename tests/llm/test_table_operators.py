import itertools
import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from surveyqc.llm import classifier as C, records as R, sharding as H, urls as U

MODEL = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, cell int")


ROWS = [
    (5, "Der Hund  läuft.\n\n Und läuft", "de", "a", 1), (2, None, None, None, 1), (9, "", "fr", "b", 1),
    (3, "a b c " * 2000, "en", "a", 1), (7, "Der Hund  läuft.\n\n Und läuft", "de", None, 1), (-4, "don't <|endoftext|> 'x", "en", "c", 1),
]


# ---- records -------------------------------------------------------------------------


def test_records_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(MODEL)
    assert 50256 in tokenizer.encode(ROWS[-1][1], add_special_tokens=False).ids
    got = {r.doc_id: r for r in R.record_round_trip(docs(spark, ROWS), MODEL).collect()}
    start = 0
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == want
        start += len(ids)


def test_records_by_the_index_and_damage(spark, tmp_path):
    rows = ROWS + [(None, "ohne Nummer", "de", "a", 1), (5, "doppelt", "de", "a", 1)]
    index = R.write_records(docs(spark, rows), MODEL, str(tmp_path / "out")).collect()
    assert len(index) == len(rows)
    for i in index:
        with open(tmp_path / "out" / i.file, "rb") as f:
            f.seek(i.offset)
            assert len(R.unpacked(R.payload_at(f, i.file))[1]) == i.n_tokens
    path = tmp_path / "out" / index[0].file
    data = bytearray(path.read_bytes())
    data[index[0].offset + 30 if index[0].length > 40 else index[0].offset + 13] ^= 1
    path.write_bytes(bytes(data))
    with open(path, "rb") as f, pytest.raises(ValueError):
        f.seek(index[0].offset)
        R.payload_at(f, "x")


def test_units_encoded_together():
    """Ids of many units in one text are those of each text on its own, whatever ends a unit."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(MODEL)
    with open(MODEL, encoding="utf-8") as f:
        units = R._encoder(f.read())
    texts = [
        "ein Wort und\nein Wort\n", "x\n\n", " vorn", "hinten ", "zwei  Leer", "\u00a0 a \u0120b \u0120", "<|endoftext|> a <|endoftext|>b",
        "don't 's 1 2 33 \u00e9\u0301 \U0001f600 x", "a" * 200_000 + " b", " ".join(f"w{i}" for i in range(30_000)), "", "\n",
    ]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in units.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_units_are_looked_up_once_and_share_their_words():
    """A word is encoded once, whatever signs and lines follow it, and ids are those of whole texts."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(MODEL)
    with open(MODEL, encoding="utf-8") as f:
        units = R.WordTable(tokenizer, json.load(f))
    asked, packed = [], units.packed
    units.packed = lambda some: asked.extend(some) or packed(some)
    known = units.encode(["x Wortschatz\nWortlaut Ende"])
    texts = [
        "x Wortschatz, Wortschatz. Wortschatz;\nWortlaut", "don't, can't. we'll!' he's'", "a.\n\nb, c.\nd\n", "\nvorn. x",
        "5, 6.7 \u00e9, \u00d7, \u0301. \U0001f600!", "a <|endoftext|>, b<|endoftext|>.\nc <|x,\ny", ".,; ... a-b, \u4e2d.", "x,",
    ]
    assert sum("Wortschatz" in unit for unit in asked) == 1
    got = [np.frombuffer(raw, "<u4").tolist() for raw in known + units.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in ["x Wortschatz\nWortlaut Ende", *texts]]
    assert sum("Wortschatz" in unit for unit in asked) == 1


def test_units_of_a_vocabulary_that_joins_across_spaces():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(MODEL)
    units = [" a", " b", " c"]
    got = R._encoded_units(tokenizer, np.zeros(60_000, bool), units)
    assert [g.tolist() for g in got] == [tokenizer.encode(u, add_special_tokens=False).ids for u in units]


def test_records_in_any_order(spark, tmp_path):
    rows = ROWS + [(None, "ohne Nummer", "de", "a", 1), (5, "doppelt", "de", "a", 1)]
    folder = str(tmp_path / "out")
    index = R.write_records(docs(spark, rows), MODEL, folder)
    whole = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in R.read_records(spark, index, folder).collect()}
    for seed in (0, 1):
        got = R.read_shuffled(spark, index, folder, seed, tasks=2).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got} == whole
    some = index.filter("n_tokens = 1")
    assert sorted(r.ids for r in R.read_shuffled(spark, some, folder).collect()) == [[0], [0]]
    with pytest.raises(Exception, match="damaged"):
        R.read_shuffled(spark, index.withColumn("offset", F.col("offset") + 1), folder).collect()


def test_ids_beyond_the_width():
    with pytest.raises(ValueError):
        R.packed(1, np.array([5, 65536], "<u4"), 2)
    assert R.unpacked(R.packed(1, np.array([5, 65536], "<u4"), 4))[1].tolist() == [5, 65536]


def test_records_of_nothing(spark):
    assert R.record_round_trip(docs(spark, []), MODEL).collect() == []


# ---- sharding ------------------------------------------------------------------------


def test_hilbert_steps_to_a_neighbour():
    for dims, bits in ((2, 3), (3, 2), (3, 4)):
        cells = sorted(itertools.product(range(1 << bits), repeat=dims), key=lambda c: H.hilbert_index(c, bits))
        assert sorted(H.hilbert_index(c, bits) for c in cells) == list(range(len(cells)))
        assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(cells, cells[1:]))


@pytest.mark.parametrize("n", [0, 1, 23, 24, 400])
def test_shards_are_even_and_slots_gapless(spark, monkeypatch, n):
    monkeypatch.setattr(H, "GROUP_ROWS", 20)
    rows = [(i // 2 if i % 7 else None, "x" * (i % 90) if i % 5 else None, "de" if i % 3 else None, f"s{i % 4}" if i % 9 else "hot", i) for i in range(n)]
    got = H.hilbert_shards(docs(spark, rows)).collect()
    assert len(got) == n and {r.law for r in got} <= {"rows"}
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
    counts = [len(shards.get(s, [])) for s in range(24)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    texts = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted((r.size, r.text_crc32) for r in got) == texts
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in ordered)


# ---- URL filter ----------------------------------------------------------------------


def judged(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    key = host.removeprefix("www.") + path.rstrip("/")
    return host, path, rule, verdict or ("block" if host and key in listed else "allow")


URLS = [
    None, "", "kein", "http://", "HTTP://WWW.Example.ORG/es/1", "https://x.example.org/en/12?q#f", "http://example.org",
    "http://a.com/fr/", "http://a.com/de/2", "http://com/de/", "http://xcom/de/", "a://b://c/d?e", "http://bad.net/x/",
    "https://www.bad.net/x?y", "http://bad.net/y", "http://É.net/x#://", "http://bad.net/x\n2", "http://x.org?/a",
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(URLS * 3)], "page_id long, url string, key string")
    listed = spark.createDataFrame([("http://bad.net/x",), (None,), ("nichts",), ("http://bad.net/x",)], "url string")
    rows = U.filter_urls(pages, listed).collect()
    assert len(rows) == len(URLS) * 3
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == judged(URLS[r.page_id % len(URLS)], {"bad.net/x"})
    assert U.filter_urls(pages, listed.filter("false")).filter("listed").count() == 0
    assert U.filter_urls(pages.filter("false"), listed).count() == 0


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """With few blocks almost every page is a possible hit, and the join still decides."""
    monkeypatch.setattr(U, "MAX_BLOCKS", 1)
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.format_string("http://h%d.net/", "id").alias("url"))
    listed = pages.filter("page_id % 2 = 0").select("url")
    rows = U.filter_urls(pages, listed).collect()
    assert {r.page_id for r in rows if r.listed} == set(range(0, 400, 2)) and len(rows) == 400


# ---- quality classifier --------------------------------------------------------------


def test_isotonic_is_the_best_rising_fit():
    got = C.isotonic(np.array([1, 1, 2, 1]), np.array([0, 1, 0, 1]))
    assert np.allclose(got, [0, 1 / 3, 1 / 3, 1])


def test_classifier_learns_and_never_sees_held_out(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        words = rng.choice(["haus", "baum", "weg", "licht"], 60) if i % 3 else rng.choice(["###", "%%%", "A1", "|"], 60)
        rows.append((i, " ".join(words), "de", "a", 0))
    df = docs(spark, rows + [(None, None, None, None, 0), (1000, "", None, None, 0)])
    labels = [(i, int(bool(i % 3)) if i % 5 else int(not i % 3)) for i in range(600)] + [(1000, None), (None, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    held = F.col("doc_id") % 5 == 0
    got = C.quality_scores(df, labels, F.col("doc_id") % 5 == 1, held).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 for r in got)
    for r in got:
        if r.doc_id is not None and r.doc_id < 600:  # labels of held-out rows are wrong on purpose
            assert r.predicted == int(bool(r.doc_id % 3)) and r.held_out == (r.doc_id % 5 == 0)


def test_classifier_without_labels(spark):
    df = docs(spark, ROWS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = C.quality_scores(df, none, F.lit(False), F.lit(False)).collect()
    assert {r.score for r in got} == {0.5} and len(got) == len(ROWS)
    assert C.quality_scores(df.filter("false"), none, F.lit(False), F.lit(False)).collect() == []

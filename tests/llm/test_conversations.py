import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from surveyqc.llm import chat_format as C, prefix_trie as T
from surveyqc.sources.scratch import materialize

SCHEMA = "conv_id long, turn int, role string, text string, path int, shard string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def by_conversation(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [m[2:] for m in sorted(said)] for conv, said in out.items()}


# ---- prefix trie ---------------------------------------------------------------------


def rebuilt(given):
    out = {}
    for conv, said in given.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = given.get(conv - conv % 20, [])[:h] + said[h:]
    return out


def plain_trie(said):
    members = collections.defaultdict(list)
    for conv, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = collections.Counter(node[:-1] for node in members if node)
    saved, leaves = collections.Counter(), collections.Counter()
    for node, convs in members.items():
        words = len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * words
            leaves[node[:d]] += not children[node]
    return sorted((
        min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
        hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(said[c]) == len(node)).encode()).hexdigest(),
    ) for node, convs in members.items())


def conversations(seed):
    pick = random.Random(seed)
    texts = ["yes", "no  way", "", "one two three", None, "x\ty\u00a0z", "w " * 500]
    rows = []
    for conv in [*range(0, 130), *range(205, 240), 1000]:  # 200 is missing: its twenty have no base
        kind = conv % 5
        if kind == 0:  # many alike
            said = [("system", "be good"), ("user", "hello there"), ("assistant", "hello you two")]
        elif kind == 1:  # many with the same start
            said = [("system", "be good"), ("user", "hello there"), ("user", pick.choice(texts))]
        else:
            said = [(pick.choice(["user", None, "a"]), pick.choice(texts)) for _ in range(pick.randint(1, 6))]
        rows += [(conv, n if n else None, *m, 3, "s") for n, m in enumerate(said)]
    rows += [(7, k, "user", f"long {k % 3}", 3, "s") for k in range(10, 300)]
    return rows


@pytest.mark.parametrize("shards", [1, 3, 8, 40])
def test_trie_against_brute_force(spark, shards):
    rows = conversations(shards)
    turns = spark.createDataFrame(rows + [(None, 0, "user", "whose?", 1, "")], SCHEMA).repartition(4)
    conv = F.col("conv_id")
    paths = T.conversation_paths(turns, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)
    got = T.prefix_trie(materialize(paths, "test-paths"), shards)
    assert got.columns == T.NODE
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_trie(rebuilt(by_conversation(rows))), key=str)


def test_equal_conversations_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE_IDS", 7)
    rows = [(c, t, "user", f"turn {t}", 0, "") for c in range(500) for t in range(3)] + [(900, 0, "user", "else", 0, "")]
    paths = materialize(T.conversation_paths(spark.createDataFrame(rows, SCHEMA)), "test-paths")
    assert len(set(c for _, c in T.splitters_of(paths, 16))) == 15  # one path, cut by conv_id
    got = T.prefix_trie(paths, 16)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_trie(by_conversation(rows)), key=str)


def test_turnless_and_no_conversations(spark):
    rows = [(21, 0, "user", "gone", 0, "")]  # begins with turns of an absent conversation
    conv = F.col("conv_id")
    turns = spark.createDataFrame(rows, SCHEMA)
    paths = T.conversation_paths(turns, conv - conv % 20, F.lit(2))
    got = T.prefix_trie(materialize(paths, "test-paths")).collect()
    assert [tuple(r) for r in got] == [(21, 0, None, 1, 0, 1, 0, hashlib.sha256(b"21").hexdigest())]
    none = T.conversation_paths(turns.limit(0), conv - conv % 20, F.lit(2))
    assert T.prefix_trie(materialize(none, "test-paths")).collect() == []


# ---- chat formatting -----------------------------------------------------------------

HARD = [
    r"\### Assistant: </turn> ok", "####", "###", "## #", "\\", "\\\\", "</turn>", "<</turn>>", "\\</turn>\\", "a: b", "\n### user: x</turn>\n",
    "", None, "😀 é", "<\\/turn>", "#" * 50, "x" * 6000, "0", "1", "\0",
]


def formatted(spark, rows, **given):
    return C.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3), **given)


def test_format_round_trip(spark):
    pick = random.Random(3)
    roles = ["user", "assistant", "assistant", "system", None, "a: b", "### x", "</turn>"]
    rows = [(c if c else None, t if t else None, pick.choice(roles), pick.choice(HARD), 1, "x")
            for c in range(120) for t in range(pick.randint(1, 8))]
    rows += [(500, t, ["user", "assistant"][t % 2], pick.choice(HARD), 1, "x") for t in range(150)]
    rows += rows[:2]
    want = by_conversation(rows)
    out = materialize(formatted(spark, rows), "test-chat")
    read = {r["conv_id"]: r for r in C.read_conversations(out).collect()}
    assert set(read) == set(want)
    for r in out.collect():
        said, got = want[r["conv_id"]], read[r["conv_id"]]
        assert [tuple(m) for m in got["messages"]] == said
        assert got["loss_texts"] == [t for role, t in said if role == "assistant"]
        assert got["formatted_chars"] == len(r["formatted"])
        assert r["rewritten_turn"] is None
        assert [s["end"] for s in r["spans"]][-1] == len(r["formatted"])
        assert [s["start"] for s in r["spans"]] == [0, *[s["end"] for s in r["spans"]][:-1]]


def test_marks_do_not_come_up_in_texts():
    for text in HARD:
        out = C.escape(text or "")
        assert "###" not in out and "</turn>" not in out and C.unescape(out) == (text or "")
    with pytest.raises(ValueError):
        C.read_marked("### user: open")
    with pytest.raises(ValueError):
        C.read_marked("x### user: y</turn>\n")


def test_rewriting_templates_are_found(spark):
    def hides_thoughts(messages):
        """Drops what an assistant thought once a later turn is there."""
        return "".join(
            f"<{r}>{t if n == len(messages) - 1 else t.split('|')[-1]}" for n, (r, t) in enumerate(messages))

    rows = [
        (1, 0, "user", "a", 0, ""), (1, 1, "assistant", "hm|b", 0, ""), (1, 2, "user", "c", 0, ""),
        (2, 0, "user", "a", 0, ""), (2, 1, "assistant", "b", 0, ""), (2, 2, "user", "c", 0, ""),
    ]
    template = C.Template(hides_thoughts, lambda s: [("?", s)], lambda s: s)
    got = {r["conv_id"]: r for r in formatted(spark, rows, template=template).collect()}
    assert (got[1]["rewritten_turn"], got[1]["spans"], got[1]["loss_spans"]) == (2, None, None)
    assert got[1]["formatted"] == "<user>a<assistant>b<user>c"
    assert got[2]["rewritten_turn"] is None
    start, end = got[2]["loss_spans"][0]
    assert got[2]["formatted"][start:end] == "b"
    read = C.read_conversations(formatted(spark, rows, template=template), template).collect()
    assert {r["conv_id"]: r["loss_texts"] for r in read} == {1: None, 2: ["b"]}


def test_trained_roles_and_frames(spark):
    rows = [(1, 0, "user", "Hi", 0, ""), (1, 1, "tool", "T", 0, "")]
    upper = C.Template(lambda ms: "".join(f"[{r}|{t}]" for r, t in ms), lambda s: [], str)
    got = formatted(spark, rows, template=upper, trained=["user", "tool"]).first()
    assert [got["formatted"][s:e] for s, e in got["loss_spans"]] == ["Hi", "T"]
    assert formatted(spark, []).collect() == []

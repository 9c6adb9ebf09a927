import bisect
import collections
import hashlib
import random
import re

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from surveyqc.llm import alignment as L

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
#: Pieces of text on which tokenizers differ, or which they change.
BITS = [
    " ", "  ", "\n", "\t", " a", "word", "don't", "'s", ".", ",", "...", "²", "_", "1", "2.5", "\0", "é", "e\u0301", "ﬁ",
    "\u2581", "<unk>", "<0x41>", "<|endoftext|>", "<s>", "漢字", "😀", "\u3000", "\xa0", "\r\n", "&", "://", "http", "ABC",
    "ß", "-", "—", "\u200b", "\ufeff", "\x85", "\x1c", "A" * 30, " " * 20, "’", "#", "\\", "}\r", ";", "\u180e", "़",
]


class Plain:
    """The contract, read word by word: no units, no tables."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.a_bytes = L.Tokenizers(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read()).a_bytes

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("\u2581", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        sides = [[(i, self.a_bytes[i]) for i in a], [(i, self.b_bytes(i)) for i in b]]
        if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
            return []
        ends = []
        for side in sides:
            n, found = 0, []
            for i, x in side:
                n += len(x)
                found.append((n, i))
            ends.append(found)
        cuts = sorted({n for n, _ in ends[0]} & {n for n, _ in ends[1]})
        groups = [([], []) for _ in cuts]
        for k, found in enumerate(ends):
            for n, i in found:
                groups[bisect.bisect_left(cuts, n)][k].append(i)
        return groups

    def rows(self, texts):
        """The measures of each document of a corpus, in order."""
        all_groups = [self.groups(t) for t in texts]
        links = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in all_groups]
        count = collections.Counter(pair for found in links for pair in found)
        best = collections.defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = []
        for g, found in zip(all_groups, links):
            shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            out.append((
                sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(found.values()),
                sum(n for p, n in found.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in found.items()),
                hashlib.sha256(shown.encode()).hexdigest() if g else "", shown))
        return out


def answers(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    return sorted((r["doc_id"], *(r[n] for n in names)) for r in df.collect())


def test_units_agree_with_whole_texts():
    plain = Plain()
    table = L.UnitTable(L.Tokenizers(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read()), 32000)
    pick = random.Random(5)
    texts = ["".join(pick.choices(BITS, k=pick.randint(1, 14))) for _ in range(3000)]
    texts += ["x y" * 5000, "abc" * 4000, "漢" * 3000, "word, two.\nMore, and 3.5." * 200]
    for start in range(0, len(texts), 300):
        part = texts[start : start + 300]
        counts, shown, (offsets, pairs, times) = table.align(part)
        for k, text in enumerate(part):
            groups = plain.groups(text)
            want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            assert shown[k] == want, text
            found = collections.Counter((x, y) for a, b in groups for x in a for y in b)
            got = zip(pairs[offsets[k] : offsets[k + 1]].tolist(), times[offsets[k] : offsets[k + 1]].tolist())
            assert {divmod(p, 32000): n for p, n in got} == dict(found), text
            assert counts[k, 3] == sum(found.values())


def test_documents_against_brute_force(spark):
    pick = random.Random(6)
    words = ["alpha", "beta", "gamma", "Straße", "don't", "2.5", "naïve", "x,y", "\n", "  "]
    texts = [" ".join(pick.choices(words, k=pick.randint(1, 30))) for _ in range(120)]
    texts += [None, "", " ", "\u2581x", "a\0b", "<|endoftext|> <s>", "copied text"] + ["copied text"] * 90 + [None] * 20
    rows = [(i if i % 11 else None, t, "d", 7, 0) for i, t in enumerate(texts)]
    rows += rows[:3]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, pair int, deal int").repartition(5)
    want = [(i, *m) for (i, *_), m in zip(rows, Plain().rows([r[1] for r in rows]))]
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    for hot in (1 << 18, 20, 1):  # all pairs broadcast, some, none
        got = L.align_documents(docs, A_PATH, B_PATH, with_groups=True, hot_pairs=hot)
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
        assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=key) == sorted(want, key=key)


def test_copies_are_aligned_once_and_dealt(spark):
    docs = spark.createDataFrame([(i, "same text of all" if i % 3 else f"own {i}") for i in range(300)], "doc_id long, text string")
    aligned = L.aligned_texts(docs, A_PATH, B_PATH)
    assert sorted(r["copies"] for r in aligned.collect()) == [1] * 100 + [200]
    assert L.align_documents(docs, A_PATH, B_PATH).groupBy("groups_sha256").count().agg({"count": "max"}).first()[0] == 200


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.align_documents(none, A_PATH, B_PATH).collect() == []
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r) for r in L.align_documents(empty, A_PATH, B_PATH).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

"""Alignment of two tokenizers, each distinct text once.

Texts are shuffled whole, so that equal ones meet and are tokenised and aligned once. Token
A comes from a byte-level BPE of the tokenizers library over space + text, token B from a
sentencepiece model over the text, to which it adds the space itself. Where tokens of both
end at the same byte, a group ends; every A token of a group is linked with every B token
of it. The count of a pair of ids is the number of documents that hold it linked: the
distinct pairs of a text count as often as there are copies of the text. Measures of the
distinct texts are joined to the documents by the SHA-256 of the text.

A text is cut into units at single spaces, which neither tokenizer lets a token straddle
(checked for the B vocabulary when it is loaded), so units that repeat are encoded and
aligned once per worker.

The pair counts go back to the texts in two ways. Fewer than ``HOT_PAIRS`` pairs can hold
more than a ``HOT_PAIRS``-th of all rows of (document, pair); those are broadcast. All
other pairs are joined by shuffle, in which none of them is large.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.common import chunks, worker_cache
from surveyqc.sources.scratch import materialize

#: Bound of the broadcast pairs; see above.
HOT_PAIRS = 1 << 18
#: A worker's table of units is emptied beyond so many units, or characters in them.
UNITS, UNIT_CHARS = 150_000, 1 << 23
#: Texts and units that go to a tokenizer at once.
CHUNK_BYTES, BATCH = 1 << 20, 4_000
#: Groups with more links than this are counted by distinct ids.
SMALL_GROUP = 64

SPACE = "▁"  # how sentencepiece writes a space
#: White space and look-alikes besides the space and the line feed, and the mark of a cut.
_OTHER = re.compile("[\0\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_RUNS = ("  ", " \n", "\n ", "\n\n")
#: Full stops and commas that could be part of a longer token.
_LOOSE = re.compile(r"[.,](?<=[\W_²].)")
_CUT = re.compile("(?<=[^\\s\0\x1c-\x1f\x85\u180e\u200b\ufeff])(?= )")


def units_of(text: str) -> list[str]:
    """Parts of a text (with its leading space) that both tokenizers treat on their own.

    Neither has a token with a space behind other characters. Where spaces and line feeds
    stand alone, a line feed is a part of its own as well, and where all full stops and
    commas follow a letter or digit, each begins a part.
    """
    if any(x in text for x in _RUNS) or _OTHER.search(text):
        return _CUT.split(text)
    text = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
    if not _LOOSE.search(text):
        text = text.replace(".", "\0.").replace(",", "\0,")
    return [p for p in text.split("\0") if p]


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_model: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, decoders

        self.a = Tokenizer.from_str(a_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        # the byte-level alphabet: printable Latin-1 as it is, the others from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(c): c for c in plain}
        byte |= {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in set(plain))}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(byte.get, t)) if all(c in byte for c in t) else t.encode()
        if not isinstance(self.a.decoder, decoders.ByteLevel):
            raise ValueError("A must be a byte-level BPE")
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace(SPACE, " ").encode())
            if not self.b.is_control(i) and (piece.strip(SPACE).count(SPACE) or piece.rstrip(SPACE) not in ("", piece)
                                             or "\n" in piece):
                raise ValueError(f"B has a token across a space or line feed: {piece!r}")

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # behind a line feed, which is a byte token, no space is added: drop both tokens
        b = [ids[2:] for ids in self.b.encode(["\n" + u for u in units], num_threads=1)]
        return a, b


class UnitTable:
    """Aligned units in flat arrays; a unit is its number."""

    def __init__(self, tokenizers: Tokenizers, b_size: int):
        self.tokenizers, self.b_size, self.all_pairs = tokenizers, b_size, len(tokenizers.a_bytes) * b_size
        self.sizes = [np.array(list(map(len, x)), np.int64) for x in (tokenizers.a_bytes, tokenizers.b_bytes)]
        # ids as text with what follows: more of the group, its B tokens, more groups, the end
        self.ids = [np.array([[f"{i}{end}" for i in range(len(x))] for end in ",|;\n"], object) for x in self.sizes]
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.shown: list[str] = []
        self.counts = array("q")  # A tokens, B tokens, groups, links, 1 if the bytes differ
        self.ends, self.pairs, self.times = array("q", [0]), array("q"), array("q")
        self.chars = 0

    def add(self, units: list[str]) -> None:
        """Encode and align units, which are not in the table yet."""
        a_bytes, b_bytes = self.tokenizers.a_bytes, self.tokenizers.b_bytes
        for start in range(0, len(units), BATCH):
            part = units[start : start + BATCH]
            a, b = self.tokenizers.encode(part)
            raw = [u.encode() for u in part]
            same = [b"".join([a_bytes[i] for i in x]) == r and b"".join([b_bytes[i] for i in y]) == r
                    for x, y, r in zip(a, b, raw)]
            if not all(same):
                for unit in (u for u, ok in zip(part, same) if not ok):
                    self._place([unit], [""], np.array([[0, 0, 0, 0, 1]]), np.zeros(1, np.int64))
                part, a, b = ([x for x, ok in zip(xs, same) if ok] for xs in (part, a, b))
            if part:
                self._align(part, a, b)

    def _place(self, units: list[str], shown: list[str], counts: np.ndarray, pairs: np.ndarray) -> None:
        first, end = len(self.shown), self.ends[-1]
        self.number.update(zip(units, range(first, first + len(units))))
        self.chars += sum(map(len, units))
        self.shown.extend(shown)
        self.counts.frombytes(counts.astype(np.int64).tobytes())
        self.ends.frombytes((np.cumsum(pairs) + end).tobytes())

    def _align(self, units: list[str], a: list[list[int]], b: list[list[int]]) -> None:
        """All units in one go: laid end to end, both tokenizers end at each unit's end, so
        a group is what lies between two ends that both have."""
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        a, b = (np.fromiter(itertools.chain.from_iterable(x), np.int64, n.sum()) for x, n in ((a, n_a), (b, n_b)))
        a_ends, b_ends = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_stop, b_stop = np.searchsorted(a_ends, ends) + 1, np.searchsorted(b_ends, ends) + 1
        a_in, b_in = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        last = np.searchsorted(a_stop, np.cumsum(n_a))  # last group of each unit
        links = a_in * b_in

        place = np.arange(len(a)) + np.repeat(b_stop - b_in, a_in)
        text = np.empty(len(a) + len(b), object)
        after = np.zeros(len(a), np.int64)
        after[a_stop - 1] = 1
        text[place] = self.ids[0][after, a]
        after = np.zeros(len(b), np.int64)
        after[b_stop - 1] = 2
        after[b_stop[last] - 1] = 3
        text[np.arange(len(b)) + np.repeat(a_stop, b_in)] = self.ids[1][after, b]
        shown = "".join(text.tolist()).split("\n")[:-1]

        large = links > SMALL_GROUP
        rows = np.where(large, 0, links)
        k = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
        wide = np.repeat(b_in, rows)
        pairs = (a[np.repeat(a_stop - a_in, rows) + k // wide] * self.b_size
                 + b[np.repeat(b_stop - b_in, rows) + k % wide])
        times, group = np.ones(len(pairs), np.int64), np.repeat(np.arange(len(ends)), rows)
        for g in np.flatnonzero(large):
            xs, ys = (np.unique(x[stop[g] - n[g] : stop[g]], return_counts=True)
                      for x, stop, n in ((a, a_stop, a_in), (b, b_stop, b_in)))
            pairs = np.append(pairs, xs[0][:, None] * self.b_size + ys[0])
            times = np.append(times, xs[1][:, None] * ys[1])
            group = np.append(group, np.full(xs[0].size * ys[0].size, g))
        unit = np.searchsorted(last, group)
        if large.any():
            order = np.argsort(unit, kind="stable")
            pairs, times, unit = pairs[order], times[order], unit[order]
        self.pairs.frombytes(pairs.tobytes())
        self.times.frombytes(times.tobytes())

        def of_units(x):
            return np.diff(np.concatenate([[0], np.cumsum(x)])[last + 1], prepend=0)

        counts = np.stack([n_a, n_b, of_units(np.ones_like(links)), of_units(links), np.zeros_like(n_a)], axis=1)
        self._place(units, shown, counts, np.bincount(unit, minlength=len(units)))

    def align(self, texts: list[str]):
        """Per text the five counts, the group texts, and distinct pairs with their times."""
        if len(self.number) > UNITS or self.chars > UNIT_CHARS:
            self.clear()
        parts = [units_of(" " + t) for t in texts]
        self.add(list(set().union(*parts).difference(self.number)))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        units = itertools.chain.from_iterable(parts)
        units = np.fromiter(map(self.number.__getitem__, units), np.int64, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        counts = np.add.reduceat(np.frombuffer(self.counts, np.int64).reshape(-1, 5)[units], first, axis=0)
        good = counts[:, 4] == 0
        counts[~good] = 0
        numbers = units.tolist()
        shown = [";".join([self.shown[u] for u in numbers[f : f + n]]) if ok else ""
                 for f, n, ok in zip(first.tolist(), sizes.tolist(), good.tolist())]
        return counts, shown, self._pairs(units, np.repeat(np.arange(len(parts)), sizes), good)

    def _pairs(self, units: np.ndarray, text: np.ndarray, good: np.ndarray):
        kept = good[text]
        units, text = units[kept], text[kept]
        ends = np.frombuffer(self.ends, np.int64)
        sizes = ends[units + 1] - ends[units]
        at = np.repeat(ends[units] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        pair, times = (np.frombuffer(x, np.int64)[at] if len(at) else np.zeros(0, np.int64) for x in (self.pairs, self.times))
        text_pair = np.repeat(text, sizes) * self.all_pairs + pair
        if (times == 1).all():
            text_pair, times = np.unique(text_pair, return_counts=True)
        else:
            order = np.argsort(text_pair)
            text_pair, starts = np.unique(text_pair[order], return_index=True)
            times = np.add.reduceat(times[order], starts)
        offsets = np.searchsorted(text_pair, np.arange(len(good) + 1) * self.all_pairs)
        return offsets, text_pair % self.all_pairs, times


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """One row per distinct text that is neither null nor empty, written once: digest,
    copies, n_a, n_b, n_groups, n_links, groups_sha256, with ``with_groups`` also groups
    (``a1,a2|b1;a3|b2,b3``), and the distinct pairs (A id * size of B + B id) with the links
    of each. A text whose joined token bytes differ from space + text has zeros, no pairs
    and an empty digest."""
    sc = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        models = sc.broadcast((a.read(), b.read()))
    key = hashlib.sha256(models.value[0].encode() + models.value[1]).hexdigest()
    a_size, b_size = vocabulary_sizes(a_path, b_path)
    pair_type = "int" if a_size * b_size < 1 << 31 else "bigint"
    arrow_type = pa.int32() if pair_type == "int" else pa.int64()
    schema = ("digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              f"pairs array<{pair_type}>, times array<int>" + (", groups string" if with_groups else ""))
    names = [f.split()[0] for f in schema.split(", ")]
    distinct = (
        docs.select(F.col(text_col).cast("string").alias("text")).filter(F.col("text") != "")
        .groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    )

    def run(batches):
        cache = worker_cache("alignment")
        if key not in cache:
            cache[key] = UnitTable(Tokenizers(*models.value), b_size)
        for chunk in chunks(batches, 0, CHUNK_BYTES):
            texts = chunk.column(0).to_pylist()
            counts, shown, (offsets, pairs, times) = cache[key].align(texts)
            digests = [hashlib.sha256(t.encode()).digest() for t in texts]
            hexes = [hashlib.sha256(s.encode()).hexdigest() if n else "" for s, n in zip(shown, counts[:, 0])]
            offsets = pa.array(offsets, pa.int32())
            columns = [pa.array(digests, pa.binary()), chunk.column(1), *[pa.array(counts[:, k]) for k in range(4)],
                       pa.array(hexes, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(pairs).cast(arrow_type)),
                       pa.ListArray.from_arrays(offsets, pa.array(times).cast(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(shown, pa.string())] * with_groups, names=names)

    made = distinct.mapInArrow(run, schema).withColumn("text_no", F.monotonically_increasing_id())
    return materialize(made, "aligned-texts")


def vocabulary_sizes(a_path: str, b_path: str) -> tuple[int, int]:
    import sentencepiece
    from tokenizers import Tokenizer

    a = max(Tokenizer.from_file(a_path).get_vocab(with_added_tokens=True).values()) + 1
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """pair, cnt (documents that hold it linked) and best (no other pair of its A id has
    more), written once."""
    counts = aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("cnt"))
    counts = materialize(counts, "pair-counts")
    a_id = F.floor(F.col("pair") / F.lit(b_size)).alias("a_id")
    top = counts.groupBy(a_id).agg(F.max("cnt").alias("top"))  # a row per id of A's vocabulary at most
    return counts.withColumn("a_id", a_id).join(F.broadcast(top), "a_id").select(
        "pair", "cnt", (F.col("cnt") == F.col("top")).alias("best"))


def text_measures(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """n_best and count_sum added to the distinct texts. Texts without pairs have zeros."""
    rows = counts.agg(F.sum("cnt")).first()[0] or 0
    is_hot = F.col("cnt") * F.lit(hot_pairs) > F.lit(rows)
    hot = counts.filter(is_hot).toPandas().sort_values("pair")  # fewer than hot_pairs rows
    shared = aligned.sparkSession.sparkContext.broadcast(
        (hot["pair"].to_numpy(np.int64), hot["cnt"].to_numpy(np.int64), hot["best"].to_numpy(np.int64)))
    pair_type = dict(aligned.dtypes)["pairs"]

    def run(batches):
        keys, cnt, best = shared.value
        for batch in batches:
            pairs, times = batch.column(1), batch.column(2)
            flat = pairs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            n = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in pairs])]).astype(np.int64)
            at = np.searchsorted(keys, flat)
            found = np.zeros(len(flat), bool)
            inside = at < len(keys)
            found[inside] = keys[at[inside]] == flat[inside]
            hit = np.where(found, at, 0)
            sums = [np.zeros(len(flat), np.int64) if not len(keys) else np.where(found, v[hit] * n, 0) for v in (best, cnt)]
            sums = [np.diff(np.concatenate([[0], np.cumsum(s)])[offsets]) for s in sums]
            rest = ~found
            left = np.concatenate([[0], np.cumsum(rest)])[offsets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(flat[rest]).cast(pairs.type.value_type)),
                 pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(n[rest]).cast(pa.int32()))],
                names=["text_no", "n_best", "count_sum", "rest", "rest_times"])

    schema = f"text_no long, n_best long, count_sum long, rest {pair_type}, rest_times array<int>"
    scored = materialize(aligned.select("text_no", "pairs", "times").mapInArrow(run, schema), "aligned-hot")
    rest = scored.select("text_no", F.inline(F.arrays_zip("rest", "rest_times"))).withColumnRenamed("rest", "pair")
    rest = rest.join(counts.filter(~is_hot), "pair").groupBy("text_no").agg(
        F.sum(F.when(F.col("best"), F.col("rest_times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("cnt") * F.col("rest_times")).alias("more_sum"))
    measured = scored.drop("rest", "rest_times").join(rest, "text_no", "left").select(
        "text_no", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))
    return aligned.drop("pairs", "times").join(measured, "text_no").drop("text_no")


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
    with_groups: bool = False, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, with ``with_groups`` also groups.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have
    zeros and an empty digest. Ids may be null or repeated: every row has its answer, and
    each counts as a document. Other columns are not read, whatever their names.

    A text with many copies has one row of measures; the documents that hold it are dealt
    over several tasks if they have more than a task's share of all rows, which fewer texts
    than there are shuffle partitions can have.
    """
    aligned = aligned_texts(docs, a_path, b_path, text_col, with_groups)
    counts = materialize(pair_counts(aligned, vocabulary_sizes(a_path, b_path)[1]), "pair-best")
    measures = materialize(text_measures(aligned, counts, hot_pairs), "aligned-measures")

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max((measures.agg(F.sum("copies")).first()[0] or 0) / parts, 1.0)
    deals = F.ceil(F.col("copies") / F.lit(share)).cast("int")
    hot = F.broadcast(measures.filter(F.col("copies") > share).select("digest", deals.alias("deals")))
    text = F.col(text_col).cast("string")
    left = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.when(text != "", F.unhex(F.sha2(text.cast("binary"), 256))).alias("digest"))
    deal = F.when(F.col("digest").isNull(), F.lit(parts)).otherwise(F.coalesce("deals", F.lit(1)))
    left = left.join(hot, "digest", "left").withColumn("deal", F.pmod(F.xxhash64("doc_id"), deal).cast("int"))
    right = measures.drop("copies").join(hot, "digest", "left").withColumn(
        "deal", F.explode(F.sequence(F.lit(0), F.coalesce("deals", F.lit(1)) - 1))).drop("deals")
    found = left.drop("deals").join(right, ["digest", "deal"], "left")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    texts = ["groups_sha256", *(["groups"] if with_groups else [])]
    return found.select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
                        *[F.coalesce(c, F.lit("")).alias(c) for c in texts])

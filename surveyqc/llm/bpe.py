"""Byte-level BPE with a rank queue of hierarchical bitmaps.

A pre-token is a linked list of byte pieces. Every neighbouring pair that the vocabulary
can merge waits in the bucket of its rank, as the position of its left piece. Which
buckets hold anything is a tree of 64-bit words, so the lowest rank is found by one
find-first-set per level, whatever the length of the pre-token. A merge makes the entries
of its neighbours stale; they are recognised when they come up and skipped. A pre-token
of n bytes takes O(n log n) at most instead of the O(n^2) of rescanning.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyqc.llm.common import map_text, texts_of, worker_cache

#: Entries of each of the two generations of a worker's table of encoded units.
UNIT_CACHE = 400_000
CACHED_CHARS = 64
#: Entries of each of the two generations of a worker's pre-tokens.
TOKEN_CACHE = 150_000
#: Bytes of pre-tokens that are merged in one queue, unless one has more; its lists then stay
#: in a processor's cache.
QUEUE_BYTES = 1 << 16

#: White space besides space and line feed, and the mark that units are cut at.
_OTHER_SPACE = "\0\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B)))
#: A cut in front of a space could part these.
_RUNS = ("  ", " \n", "\n ")


def vocabulary_lines(spark: SparkSession, path: str) -> list[str]:
    """The rank file as lines. A vocabulary is bounded, so it goes with the job."""
    with open(path, encoding="ascii") as f:
        return f.read().splitlines()


class RankQueue:
    """Positions by rank: buckets, and bitmaps over those in use, 64 children to a word.

    A bucket is a heap. It is sorted, which leaves it one, and read in order when it is first
    taken; only if a lower rank comes up before its end is the rest popped one by one.
    """

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.left: set[int] = set()
        self.levels: list[list[int]] = []
        while True:
            ranks = (ranks + 63) >> 6
            self.levels.append([0] * max(ranks, 1))
            if ranks <= 1:
                break

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.fill(rank, [position])
        else:
            heapq.heappush(bucket, position)

    def fill(self, rank: int, positions: list[int]) -> None:
        """A bucket of ascending positions for a rank that has none."""
        self.buckets[rank] = positions
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            was = level[word]
            level[word] = was | bit
            if was:
                break
            rank = word

    def take(self, rank: int) -> Iterable[int]:
        """The positions of a rank in ascending order; :meth:`leave` is told how many were taken."""
        bucket = self.buckets[rank]
        if rank in self.left:
            return map(heapq.heappop, itertools.repeat(bucket, len(bucket)))
        bucket.sort()
        return bucket

    def leave(self, rank: int, taken: int) -> None:
        bucket = self.buckets[rank]
        if rank not in self.left:
            del bucket[:taken]
            self.left.add(rank)
        if not bucket:
            self.drop(rank)

    def first(self) -> int:
        """The lowest rank with a bucket, -1 if there is none."""
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            if not word:
                return -1
            rank = (rank << 6) | ((word & -word).bit_length() - 1)
        return rank

    def drop(self, rank: int) -> None:
        """Take an empty bucket away."""
        del self.buckets[rank]
        self.left.discard(rank)
        for level in self.levels:
            word = rank >> 6
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                break
            rank = word


class BytePairEncoder:
    """Encodes and decodes by a table of ranks, each match of a pattern on its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        self.decimals = list(map(str, range(len(self.pieces))))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.split = regex.compile(pattern)
        self.base = max(ranks.values(), default=0) + 1
        self.queue = RankQueue(self.base)
        self.bytes = {b[0]: i for b, i in ranks.items() if len(b) == 1}
        #: Ranks of two bytes, -1 for none, by their numbers.
        self.byte_pairs = np.full(1 << 16, -1, np.int64)
        for b, i in ranks.items():
            if len(b) == 2 and b[0] in self.bytes and b[1] in self.bytes:
                self.byte_pairs[b[0] << 8 | b[1]] = i
        self.pairs = {
            ranks[b[:at]] * self.base + ranks[b[at:]]: i
            for b, i in ranks.items() for at in range(1, len(b)) if b[:at] in ranks and b[at:] in ranks
        }

    @classmethod
    def from_lines(cls, lines: list[str], pattern: str) -> BytePairEncoder:
        return cls({base64.b64decode(a): int(b) for a, b in map(str.split, lines) if a}, pattern)

    def merge(self, tokens: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers. All share one queue: no pair
        crosses a pre-token's end, so the order among pre-tokens changes nothing."""
        data = b"".join(tokens)
        base, pair, queue, push = self.base, self.pairs.get, self.queue, self.queue.push
        piece = list(map(self.bytes.__getitem__, data))  # -1 once it is merged away
        stops = np.cumsum(list(map(len, tokens)))
        neighbours = np.arange(-1, len(data) + 1)
        before, after = neighbours[:-2].copy(), neighbours[2:].copy()
        before[stops[:-1]] = -1
        after[stops - 1] = -1
        before, after = before.tolist(), after.tolist()
        codes = np.frombuffer(data, np.uint8).astype(np.intp)
        ranks = self.byte_pairs[codes[:-1] << 8 | codes[1:]]
        ranks[stops[:-1] - 1] = -1
        order = np.argsort(ranks, kind="stable")
        order = order[np.count_nonzero(ranks < 0):]
        if len(order):
            for positions in np.split(order, np.flatnonzero(np.diff(ranks[order])) + 1):
                queue.fill(int(ranks[positions[0]]), positions.tolist())
        while (rank := queue.first()) >= 0:
            lower = False
            for taken, i in enumerate(queue.take(rank), 1):
                j = after[i]
                if j < 0 or piece[i] < 0 or pair(piece[i] * base + piece[j]) != rank:
                    continue  # stale: a neighbour's merge has changed this pair
                k, left = after[j], before[i]
                piece[i], piece[j], after[i] = rank, -1, k
                if k >= 0:
                    before[k] = i
                    made = pair(rank * base + piece[k])
                    if made is not None:
                        push(made, i)
                        lower = made < rank
                if left >= 0:
                    made = pair(piece[left] * base + rank)
                    if made is not None:
                        push(made, left)
                        lower = lower or made < rank
                if lower:
                    break
            queue.leave(rank, taken)
        rest = np.asarray(piece)
        ends = (4 * np.cumsum(rest >= 0)[stops - 1]).tolist()
        ids = rest[rest >= 0].astype("<u4").tobytes()
        return [ids[start:stop] for start, stop in zip([0, *ends], ends)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        return [np.frombuffer(ids, "<u4").tolist() for ids in self.packed(texts)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers. Short pre-tokens that took merges
        are kept in two generations, as they come again in other units, with other signs behind
        them. Bytes are kept, which the garbage collector need not look through."""
        if len(self.young) > TOKEN_CACHE:
            self.young, self.old = {}, self.young
        split = [self.split.findall(text) for text in texts]
        known: dict[str, bytes] = {}
        waiting: list[str] = []
        held = 0

        def merged():
            for token, ids in zip(waiting, self.merge([t.encode() for t in waiting])):
                known[token] = ids
                if len(token) <= CACHED_CHARS:
                    self.young[token] = ids

        for token in set().union(*split) if split else ():
            ids = self.young.get(token)
            if ids is None and (ids := self.old.get(token)) is not None:
                self.young[token] = ids
            if ids is not None:
                known[token] = ids
                continue
            raw = token.encode()
            if raw in self.ranks:
                known[token] = self.ranks[raw].to_bytes(4, "little")
                continue
            waiting.append(token)
            held += len(raw)
            if held >= QUEUE_BYTES:
                merged()
                waiting, held = [], 0
        if waiting:
            merged()
        return [b"".join(map(known.__getitem__, tokens)) for tokens in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def is_cut(text: str) -> bool:
    """Whether the text falls into units in front of its spaces that can be encoded on their own.

    No pre-token has white space behind other characters, so where no space meets other white
    space, a cut in front of a space parts no pre-token and changes no look-ahead.
    """
    return not (
        text[0] == " " or text[-1] == " " or any(x in text for x in _RUNS) or any(x in text for x in _OTHER_SPACE)
    )


class UnitTable:
    """Ids of the units of texts, in two generations so that frequent units stay. ``packed``
    gives the ids of each of a list of units as little-endian 32-bit integers; texts that are
    not cut at spaces are given to ``split``."""

    def __init__(self, packed, split):
        self.packed, self.split = packed, split
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def packed_cut(self, units: list[str]) -> list[bytes]:
        """As ``packed``, for units that are cut at spaces."""
        return self.packed(units)

    def known(self, units: list[str], packed) -> list[bytes]:
        """Ids of each of the units, which differ."""
        found = list(map(self.young.get, units))
        missing = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = self.old.get(units[i])
            if found[i] is None:
                missing.append(i)
            else:
                self.young[units[i]] = found[i]
        for i, ids in zip(missing, packed([units[i] for i in missing])):
            found[i] = ids
            if len(units[i]) <= CACHED_CHARS:
                self.young[units[i]] = ids
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers. The units of all texts are numbered
        in Arrow, and each that occurs is looked up once."""
        if len(self.young) > UNIT_CACHE:
            self.young, self.old = {}, self.young
        out = [b""] * len(texts)
        plain = [i for i, text in enumerate(texts) if text and is_cut(text)]
        if plain:
            marked = pc.replace_substring(pa.array([texts[i] for i in plain], pa.large_string()), " ", "\0 ")
            parts = pc.split_pattern(marked, "\0")
            units = parts.values.dictionary_encode()
            known = self.known(units.dictionary.to_numpy(zero_copy_only=False).tolist(), self.packed_cut)
            ids = pa.array(known, pa.large_binary()).take(units.indices)
            starts = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[parts.offsets.to_numpy()].tolist()
            data = memoryview(ids.buffers()[2] or b"")
            for i, start, end in zip(plain, starts, starts[1:]):
                out[i] = bytes(data[start:end])
        whole = {i: self.split(text) for i, text in enumerate(texts) if text and not is_cut(text)}
        if whole:
            units = list(set().union(*whole.values()))
            ids = dict(zip(units, self.known(units, self.packed)))
            for i, parts in whole.items():
                out[i] = b"".join(map(ids.__getitem__, parts))
        return out


def encoder(lines: list[str], pattern: str, key: str) -> tuple[BytePairEncoder, UnitTable]:
    """The encoder and its table, made once per worker and vocabulary."""
    cache = worker_cache("bpe")
    if key not in cache:
        made = BytePairEncoder.from_lines(lines, pattern)
        cache[key] = made, UnitTable(made.packed, made.split.findall)
    return cache[key]


def bpe_round_trip(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256
    (of the bytes decoded from the ids), with ``with_ids`` also ids, one row per row.

    ``path`` is a file of base64 pieces and ranks, read by the driver and broadcast: its
    size is that of the vocabulary. A null text counts as empty, which has no ids. Ids of
    documents may be null or repeated; every row gets its own answer. Other columns are
    not read.
    """
    lines = vocabulary_lines(docs.sparkSession, path)
    shared = docs.sparkSession.sparkContext.broadcast(lines)
    key = hashlib.sha256("\n".join([pattern, *lines]).encode()).hexdigest()

    def make():
        bpe, units = encoder(shared.value, pattern, key)
        decimals = bpe.decimals.__getitem__

        def run(chunk):
            counts, id_digests, text_digests, lists = [], [], [], []
            for raw in units.encode([text.decode() for text in texts_of(chunk.column(1))]):
                ids = np.frombuffer(raw, "<u4").tolist()
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(",".join(map(decimals, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(ids)
            out = [chunk.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                   pa.array(text_digests, pa.string())]
            return out + [pa.array(lists, pa.list_(pa.int64()))] * with_ids

        return run

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_text(rows, ["doc_id"], "text", make, schema + ", ids array<long>" * with_ids)

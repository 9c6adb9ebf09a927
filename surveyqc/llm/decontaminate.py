"""Benchmark passages in training text by a generalised suffix automaton.

The automaton holds every run of words of the test items. A document's words are streamed
through it and the longest match that ends at each word is tracked; where it covers a
window of an item, the window's words are hit. Test items are few against the documents:
they are cut into blocks of bounded size, each block's automaton is broadcast, and one
pass over all documents is made per block.
"""

from __future__ import annotations

import hashlib
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.common import chunks, texts_of, worker_cache
from surveyqc.sources.scratch import materialize

WINDOW = 13
#: Bytes of item texts in one automaton, and so in one broadcast.
BLOCK_BYTES = 1 << 20
_PAIR_BITS = 22

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all that is not ASCII, A-Z lower-cased."""
    return text.translate(_WORDS).split()


class Automaton:
    """Suffix automaton of several word sequences, with the windows that make a hit."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for name, text in items:
            seq = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            if seq:
                sequences.append((name, seq))
        last = 0
        for _, seq in sequences:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.owners: dict[int, set] = {}  # state of a full window -> items
        self.short: dict[int, dict[int, set]] = {}  # state -> length of a short item -> items
        self.single: dict[int, set] = {}
        for name, seq in sequences:
            if len(seq) == 1:
                self.single.setdefault(seq[0], set()).add(name)
                continue
            state, matched = 0, 0
            for c in seq:
                state, matched = self._step(state, matched, c)
                if matched >= window:
                    self.owners.setdefault(self._holding(state, window), set()).add(name)
            if len(seq) < window:
                self.short.setdefault(self._holding(state, len(seq)), {}).setdefault(len(seq), set()).add(name)
        self.least = min((min(len(s), window) for _, s in sequences if len(s) > 1), default=0)
        self.pairs = np.zeros(1 << _PAIR_BITS, bool)
        for _, seq in sequences:
            self.pairs[self._slot(np.array(seq, np.uint64))] = True

    @staticmethod
    def _slot(ids: np.ndarray) -> np.ndarray:
        key = ids[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ ids[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        return (key * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - _PAIR_BITS)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _state(self, length: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        nxt = self.next
        while state and c not in nxt[state]:
            state = self.link[state]
            matched = self.length[state]
        to = nxt[state].get(c)
        return (0, 0) if to is None else (to, matched + 1)

    def _holding(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what was matched."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans of word positions (end exclusive), which may overlap, and items hit."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.uint64, len(words))
        if self.single:
            for at in np.flatnonzero(np.isin(ids, np.array(list(self.single), np.uint64))).tolist():
                spans.append((at, at + 1))
                items |= self.single[int(ids[at])]
        if self.least and len(words) >= self.least:
            # a match of n words needs n - 1 neighbouring pairs that occur in the items
            ok = self.pairs[self._slot(ids)] & (ids[:-1] > 0) & (ids[1:] > 0)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], ok.view(np.int8), [0]])))
            for start, stop in edges.reshape(-1, 2).tolist():
                if stop - start + 1 >= self.least:
                    self._walk(ids[start : stop + 1].tolist(), start, spans, items)
        return spans, items

    def _walk(self, ids: list[int], offset: int, spans: list, items: set) -> None:
        state, matched = 0, 0
        for at, c in enumerate(ids, offset + 1):
            state, matched = self._step(state, matched, c)
            if matched >= self.window:
                spans.append((at - self.window, at))
                items |= self.owners[self._holding(state, self.window)]
            if self.short:
                up, longest = state, matched
                while up:
                    for size, names in self.short.get(up, {}).items():
                        if size <= longest:
                            spans.append((at - size, at))
                            items |= names
                    up = self.link[up]
                    longest = self.length[up]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORDS))]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join(kept) + text[at:]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """Lists of (item id, text), each of bounded size."""
    items = benchmark.filter(F.length(text_col) > 0).select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("item", "text"), F.lit(max(count, 1)))
    for i in range(count):
        rows = items.filter(block == i).select("item", F.col("text").cast("binary")).collect()
        yield i == count - 1, sorted(((r[0], bytes(r[1])) for r in rows), key=lambda x: (x[0] or "", x[1]))
    if not count:
        yield True, []


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", keep_columns: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted item ids joined by
    commas), contaminated and clean_text, one row per row; with ``keep_columns`` all
    columns of the documents and then these but the first.

    A window is 13 consecutive words of an item, or all words of a shorter one. The words
    of a document inside an occurrence of a window are hit. It is contaminated if they
    are one in twenty of its words or more. ``clean_text`` then lacks the hit spans and is
    the text as it is otherwise.

    A null or empty text has no words and no hits; an item without words has no window. An
    item with a null id makes hits but is not counted; rows with one item id are one item.
    Ids of documents may be null or repeated. With no items nothing is hit.
    """
    spark = docs.sparkSession
    columns = [F.col(f"`{c}`") for c in docs.columns] if keep_columns else [F.col(id_col).cast("long").alias("doc_id")]
    state = docs.select(
        F.struct(*columns).alias("row"), F.lit(None).cast("array<long>").alias("spans"),
        F.lit(None).cast("array<string>").alias("items"), F.col(text_col).alias("text"),
    )
    row_type = state.schema["row"].dataType.simpleString()
    results = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, clean_text string"
    for last, items in _blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(items)
        key = hashlib.sha256(repr(items).encode()).hexdigest()

        def run(batches, shared=shared, key=key, last=last):
            cache = worker_cache("automata")
            if key not in cache:
                cache.clear()
                cache[key] = Automaton(shared.value)
            automaton = cache[key]
            for chunk in chunks(batches, 3):
                yield _finish(chunk, automaton) if last else _pass(chunk, automaton)

        if last:
            state = state.mapInArrow(run, f"row {row_type}, {results}")
        else:
            state = materialize(state.mapInArrow(run, state.schema), "decontaminate-pass")
    made = [F.col(p.split()[0]) for p in results.split(", ")]
    if keep_columns:
        return state.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], *made)
    return state.select("row.doc_id", *made)


def _found(chunk: pa.RecordBatch, automaton: Automaton):
    before = chunk.column(1).to_pylist(), chunk.column(2).to_pylist()
    for text, flat, names in zip(texts_of(chunk.column(3)), *before):
        words = words_of(text)
        spans, items = automaton.find(words)
        if flat:
            spans += list(zip(flat[::2], flat[1::2]))
        if names:
            items = items.union(names)
        yield text, len(words), merged(spans), items


def _pass(chunk: pa.RecordBatch, automaton: Automaton) -> pa.RecordBatch:
    spans, items = [], []
    for _, _, found, names in _found(chunk, automaton):
        spans.append([x for span in found for x in span])
        items.append(sorted(n for n in names if n is not None))
    columns = [chunk.column(0), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), chunk.column(3)]
    return pa.RecordBatch.from_arrays(columns, names=["row", "spans", "items", "text"])


def _finish(chunk: pa.RecordBatch, automaton: Automaton) -> pa.RecordBatch:
    out: dict[str, list] = {k: [] for k in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")}
    cleaned = []
    given = chunk.column(3)
    for i, (text, n, spans, items) in enumerate(_found(chunk, automaton)):
        hit = sum(b - a for a, b in spans)
        names = sorted(x for x in items if x is not None)
        dirty = hit > 0 and 20 * hit >= n
        for k, v in zip(out, (n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), dirty)):
            out[k].append(v)
        cleaned.append(without(text, spans).decode() if dirty else given[i].as_py())
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    columns = [pa.array(v, kind) for v, kind in zip(out.values(), kinds)]
    return pa.RecordBatch.from_arrays(
        [chunk.column(0), *columns, pa.array(cleaned, pa.string())], names=["row", *out, "clean_text"]
    )

"""Secrets by patterns and by token efficiency.

A vocabulary learnt from language spells words in few tokens and random strings in many.
Long unbroken strings with few characters per token are reported, unless they are known
digests or identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.common import map_text, texts_of, worker_cache

KINDS = ("assign", "access", "hex", "random")

#: Fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
NAMES = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)

#: Strings that may be random: long and of one alphabet.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
#: Digests by their lengths in hexadecimal, UUIDs, plain numbers, and rules of marks or of one character.
KNOWN = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64}"
    r"|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9-]+|[-_/=+]+|(.)\1*)", re.DOTALL
)
#: What stands between the words of a name, and the number at its end.
BETWEEN = re.compile(r"[-_/=+]+")
NUMBER = re.compile(r"(?<![0-9])[0-9]{1,4}\Z")
#: Characters per token under which a string counts as random.
CHARS_PER_TOKEN = 2.2


def _encoding(lines: list[str], pattern: str, key: str):
    cache = worker_cache("tiktoken")
    if key not in cache:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines) if a}
        cache[key] = tiktoken.Encoding(key, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return cache[key]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the certain patterns, in order."""
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if NAMES.search(text):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    return sorted(spans)


def is_name(s: str, encoding, limit: float) -> bool:
    """Whether all parts of a string are words, each with enough characters per token, but
    for up to four digits at the end. Parts of one or two letters say little: they may be at
    most half of the letters."""
    parts = [p for p in BETWEEN.split(NUMBER.sub("", s)) if p]
    if not all(p.isalpha() for p in parts):
        return False
    long = [p for p in parts if len(p) > 2]
    if 2 * sum(map(len, long)) < sum(map(len, parts)):
        return False
    spelt = [p.lower() if p.isupper() else p for p in long]  # words in capitals have more tokens
    return all(len(p) >= limit * len(encoding.encode_ordinary(p)) for p in spelt)


def random_spans(text: str, encoding, limit: float, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Strings with few characters per token that no certain span touches."""
    out = []
    for m in CANDIDATE.finditer(text):
        start, end, s = m.start(), m.end(), m[0]
        if KNOWN.fullmatch(s) or any(a < end and start < b for a, _, b in base):
            continue
        if len(s) < limit * len(encoding.encode_ordinary(s)) and not is_name(s, encoding, limit):
            out.append((start, 3, end))
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    limit: float = CHARS_PER_TOKEN,
) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the certain spans), spans (all) and
    n_random, one row per row. Spans are kind:start:end in code points, the end exclusive,
    ordered by start and kind.

    ``path`` is a rank file for tiktoken; it is broadcast, its size is the vocabulary's. A
    null or empty text has no spans. Ids may be null or repeated; every row is answered.
    """
    with open(path, encoding="ascii") as f:
        lines = f.read().splitlines()
    shared = docs.sparkSession.sparkContext.broadcast(lines)
    key = hashlib.sha256("\n".join([pattern, *lines]).encode()).hexdigest()

    def make():
        encoding = _encoding(shared.value, pattern, key)

        def run(chunk):
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, written = [], []
            for raw in texts_of(chunk.column(1)):
                text = raw.decode()
                base = base_spans(text)
                spans = sorted(base + random_spans(text, encoding, limit, base))
                for k, column in enumerate(counts):
                    column.append(sum(s[1] == k for s in spans))
                digests.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(spans))
            numbers = [pa.array(c, pa.int64()) for c in counts]
            return [chunk.column(0), *numbers[:3], pa.array(digests), pa.array(written), numbers[3]]

        return run

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return map_text(rows, ["doc_id"], "text", make, schema)

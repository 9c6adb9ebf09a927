"""Quality scores by kernel ridge regression on random Fourier features.

Each document is reduced to a few statistics of its text. Cosines of random projections of
the standardised statistics approximate a Gaussian kernel. Every partition of labelled
documents adds up its share of the normal equations, the shares are summed, and a small
system is solved. Scores are calibrated to the share of good documents by isotonic
regression on labelled documents that the fit did not see.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.common import map_text, texts_of
from surveyqc.sources.scratch import materialize

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "word_spread", "distinct_words", "top_word", "repeated_trigrams",
    "upper", "digit", "symbol", "mark", "beyond_ascii", "line_ends", "distinct_lines", "single_letters",
)
FEATURES = 160
WIDTH = 4.0
RIDGE = 1e-2
BINS = 512
SEED = 20240229


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.int64)
    for c in range(256):
        kind[c] = (
            6 if c >= 128 else 5 if c == 10 else 4 if chr(c) in ".,;:!?'\"()-" else 3 if 33 <= c <= 126 and not chr(c).isalnum()
            else 2 if chr(c).isdigit() else 1 if chr(c).isupper() else 0
        )
    return kind


_CLASS = _classes()


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text, each near 0 for an empty one."""
    n = len(text)
    counts = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=7) / max(n, 1)
    words = text.split()
    m = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    table: dict[bytes, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
    top = np.bincount(ids).max() / m if words else 0.0
    triples = (ids[:-2] * len(table) + ids[1:-1]) * len(table) + ids[2:]
    repeated = 1 - len(np.unique(triples)) / len(triples) if len(triples) > 0 else 0.0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        np.log1p(n), np.log1p(len(words)), lengths.mean(), lengths.std(), len(table) / m, top, repeated,
        counts[1], counts[2], counts[3], counts[4], counts[6], counts[5] * 100,
        len(set(lines)) / max(len(lines), 1), float((lengths == 1).sum()) / m,
    ]


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def make():
        def run(chunk):
            rows = [statistics(t) for t in texts_of(chunk.column(1))]
            return chunk.column(0), pa.array(rows, pa.list_(pa.float64()))

        return run

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_text(rows, ["doc_id"], "text", make, "doc_id long, x array<double>")


class Features:
    """Standardised statistics to random cosines and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = rng.normal(size=(len(mean), features)) / WIDTH
        self.shift = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        out = np.cos(z @ self.w + self.shift) * np.sqrt(2 / len(self.shift))
        return np.hstack([out, np.ones((len(x), 1))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def fit(labelled: DataFrame) -> tuple[Features, np.ndarray]:
    """Features and weights from rows (x, y)."""
    size = len(STATISTICS)
    x = [F.get(F.col("x"), F.lit(i)) for i in range(size)]
    row = labelled.agg(
        *[F.coalesce(F.avg(c), F.lit(0.0)) for c in x], *[F.coalesce(F.stddev_pop(c), F.lit(1.0)) for c in x]
    ).first()
    features = Features(np.array(row[:size]), np.array(row[size:]))
    width = len(features.shift) + 1

    def shares(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            f = features(_matrix(batch.column(0), size))
            total += f.T @ np.hstack([f, np.asarray(batch.column(1)).reshape(-1, 1)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"]
        )

    rows = labelled.select("x", F.col("y").cast("double")).mapInArrow(shares, "i int, row array<double>")
    cells = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((width, width + 1))
    for i, j, v in cells.collect():  # (FEATURES + 1) squared numbers, whatever the data
        total[i, j] = v
    a = total[:, :-1] + RIDGE * np.eye(width)
    return features, np.linalg.solve(a, total[:, -1])


def isotonic(n: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The rising sequence that fits good / n best, weighted by n."""
    blocks: list[list[float]] = []
    for count, hits in zip(n.tolist(), good.tolist()):
        blocks.append([hits, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            hits, count, size = blocks.pop()
            blocks[-1] = [blocks[-1][0] + hits, blocks[-1][1] + count, blocks[-1][2] + size]
    return np.repeat([h / c for h, c, _ in blocks], [int(s) for *_, s in blocks])


def quality_scores(
    docs: DataFrame, labels: DataFrame, calibrate: Column, held_out: Column, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality", cut: float = 0.3,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from ``cut`` on), one row per row.

    ``held_out`` and ``calibrate`` are conditions on the column doc_id: rows of the first
    are never learnt from, those of the second only calibrate. All other labelled rows are fitted.

    A null or empty text has the statistics of an empty text and its score. A null id has
    no label and is not held out; repeated labels and rows count as often as they occur.
    Null labels do not count. With no labels every score is 0.5.
    """
    rows = materialize(with_statistics(docs, id_col, text_col), "classifier-statistics")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    known = known.filter("doc_id is not null and y is not null").filter(~held_out)
    known = materialize(
        rows.join(known, "doc_id").select("x", "y", calibrate.alias("calibrate")), "classifier-labelled")
    features, weights = fit(known.filter("not calibrate"))
    size = len(STATISTICS)

    def raw(column: pa.Array) -> np.ndarray:
        return np.clip(features(_matrix(column, size)) @ weights, 0, 1)

    def binned(batches):
        for batch in batches:
            bins = np.minimum((raw(batch.column(0)) * BINS).astype(np.int32), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], names=["bin", "y"])

    seen = known.filter("calibrate").select("x", "y").mapInArrow(binned, "bin int, y double")
    cells = sorted(seen.groupBy("bin").agg(F.count("y"), F.sum("y")).collect())  # BINS rows at most
    table = np.array([[0.5 / BINS, 1, 0.5]] if not cells else [[(b + 0.5) / BINS, n, g] for b, n, g in cells])
    at, level = table[:, 0], isotonic(table[:, 1], table[:, 2])

    def scored(batches):
        for batch in batches:
            if batch.num_rows:
                score = np.interp(raw(batch.column(1)), at, level)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    out = rows.select("doc_id", "x").mapInArrow(scored, "doc_id long, score double")
    return out.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"),
    )

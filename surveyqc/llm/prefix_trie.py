"""The prefix trie of conversations, by the skeleton of range splitters.

A turn is a 128-bit digest of role and text, a conversation the path of its turns. Splitters
from a sample cut the sorted (path, conv_id) into shards, so equal paths can be dealt over
several. A node of the trie is a run of sorted paths with the same first turns. Nearly all
runs lie within one shard, which finishes the node alone. Those that go on across a border
are prefixes of the splitter there. The trie of the splitter paths, the skeleton, is
broadcast; each shard adds its part of a skeleton node, and the parts are combined by
reduction.

The skeleton has at most one path per border, whatever the number of rows. A path is one row
of 16 bytes a turn, so the digests of a conversation must fit a task; conversations with
equal turns, equal first turns or equal ends may be any part of the table.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyqc.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Sampled paths per shard, from which the splitters are taken.
SAMPLES = 20
#: Rows of a task's output at once, and conv_ids in a piece of a skeleton node's ends.
ROWS, PIECE_IDS = 10_000, 1_000

#: What a shard returns: finished nodes, its parts of skeleton nodes, pieces of their ends.
#: ``skeleton`` is the skeleton node meant, or the one above a finished node.
FINISHED, PART, ENDS = 0, 1, 2
_SHARD = ("kind int, skeleton long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string, words long, shard long, piece long, ends binary")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NONE = hashlib.sha256(b"").hexdigest()


def conversation_paths(
    turns: DataFrame, base: Column | None = None, shared_turns: Column | None = None,
) -> DataFrame:
    """One row per conv_id: path (digests of its turns in order) and words (of each turn).

    Turns are ordered by turn, null first, equal ones by digest; null roles and texts count
    as empty. Rows without a conv_id belong to no conversation. ``base`` and
    ``shared_turns`` are expressions over conv_id: the conversation then starts with the
    first ``shared_turns`` turns of the given conversation ``base`` (of all if it has
    fewer, of none if it is absent) and goes on with its own behind its first
    ``shared_turns``.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    row = F.struct(
        F.col("turn"), F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)).alias("d"),
        F.regexp_count(text, F.lit(WORD)).alias("w"))
    given = (
        turns.filter(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("row"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select("conv_id", F.transform("rows", lambda r: F.struct(r["d"].alias("d"), r["w"].alias("w"))).alias("rows"))
    )
    if base is not None:
        given = materialize(given, "conversations")
        own = given.withColumn("h", shared_turns.cast("int")).withColumn("base", base)
        # a conversation is the base of a few others: only its first turns are needed
        most = own.agg(F.max("h")).first()[0] or 0
        heads = given.select(F.col("conv_id").alias("base"), F.slice("rows", 1, max(most, 1)).alias("head"))
        wanted = own.select("base").distinct()
        heads = heads.join(wanted, "base", "left_semi")
        first = F.when(F.col("head").isNotNull() & (F.col("h") > 0), F.slice("head", F.lit(1), F.greatest("h", F.lit(1))))
        rest = F.slice("rows", F.col("h") + 1, F.greatest(F.size("rows") - F.col("h"), F.lit(0)))
        given = own.join(heads, "base", "left").select(
            "conv_id", F.concat(F.coalesce(first, F.slice("rows", 1, 0)), rest).alias("rows"))
    return given.select("conv_id", F.col("rows.d").alias("path"), F.col("rows.w").alias("words"))


def shared_prefix(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Skeleton:
    """The trie of the splitter paths: children by (node, turn), the root is 0."""

    def __init__(self, paths: list[list[bytes]]):
        self.children: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path in paths:
            node = 0
            for turn in path:
                child = self.children.get((node, turn))
                if child is None:
                    child = self.children[node, turn] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = child


class Node:
    """A run of paths that is not closed yet."""

    __slots__ = ("skeleton", "words", "least", "convs", "children", "leaves", "saved", "digest", "ids", "pieces", "below")

    def __init__(self, skeleton: int, words: int):
        self.skeleton, self.words, self.least = skeleton, words, None
        self.convs = self.children = self.leaves = self.saved = self.pieces = 0
        self.digest = None  # of the ends, if this shard finishes the node
        self.ids: list[str] = []  # ends of a skeleton node that are in no piece yet
        self.below: list[list] = []  # finished children, until the smallest member is known

    def joined(self, least: int) -> None:
        self.least = least if self.least is None else min(self.least, least)


def trie_shard(rows, skeleton: Skeleton, shard: int, out: list):
    """Go through sorted (path, words, conv_id) of one shard and add rows of ``_SHARD`` to
    ``out``; yields after each conversation, so that ``out`` can be emptied."""
    stack, last = [Node(0, 0)], []

    def piece(node: Node) -> None:
        if node.ids:
            ends = ",".join(node.ids).encode()
            out.append([ENDS, node.skeleton, *[None] * 8, None, shard, node.pieces, ends])
            node.ids, node.pieces = [], node.pieces + 1

    def close() -> None:
        node = stack.pop()
        above = stack[-1] if stack else None
        if above is not None:
            above.convs += node.convs
            above.joined(node.least)
        for row in node.below:
            row[4] = node.least
        out.extend(node.below)
        if node.skeleton >= 0:  # other shards may have more of it
            piece(node)
            out.append([PART, node.skeleton, node.least, None, None, node.convs, node.children, node.leaves, node.saved,
                        None, node.words, shard, None, None])
            return
        node.saved += (node.convs - 1) * node.words
        node.leaves = node.leaves or 1
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        row = [FINISHED, above.skeleton, node.least, len(stack), None, node.convs, node.children, node.leaves, node.saved,
               node.digest.hexdigest() if node.digest else _NONE, None, None, None, None]
        (out if above.skeleton >= 0 else above.below).append(row)

    for path, words, conv in rows:
        keep = shared_prefix(last, path)
        while len(stack) > keep + 1:
            close()
        for k in range(keep, len(path)):
            above = stack[-1].skeleton
            stack.append(Node(skeleton.children.get((above, path[k]), -1) if above >= 0 else -1, words[k]))
        node, last = stack[-1], path
        node.convs += 1
        node.joined(conv)
        if node.skeleton >= 0:
            node.ids.append(str(conv))
            if len(node.ids) == PIECE_IDS:
                piece(node)
        elif node.digest is None:
            node.digest = hashlib.sha256(str(conv).encode())
        else:
            node.digest.update(b"," + str(conv).encode())
        yield
    while stack:
        close()
    yield


def _batch(rows: list[list]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in _SHARD.split(", ")]
    arrays = [pa.array(c, types[kind]) for c, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def splitters_of(paths: DataFrame, shards: int) -> list[tuple[list[bytes], int]]:
    """At most ``shards`` - 1 sorted (path, conv_id), from ``SAMPLES`` a shard: those with
    the smallest hashes of their conv_id, about."""
    n = paths.count()
    part = min(1.0, SAMPLES * shards / max(n, 1))
    sample = paths.select("path", "conv_id").filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    found = sorted((r["path"], r["conv_id"]) for r in sample.collect())
    found = [([bytes(t) for t in path], conv) for path, conv in found]
    step = len(found) / shards
    return [found[int(k * step)] for k in range(1, shards)] if step >= 1 else found


def _finished_skeleton(skeleton: Skeleton, parts: DataFrame) -> DataFrame:
    """The nodes of the skeleton from the parts of all shards. Spark combines the parts; what
    is added up along the skeleton, one row a node, is added on the driver."""
    least, total = F.min("conv_id").alias("least"), [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    combined = parts.filter(F.col("kind") == PART).groupBy("skeleton").agg(least, F.max("words").alias("words"), *total)
    sums = {r["skeleton"]: r for r in combined.collect()}
    n = len(skeleton.parent) if sums else 0
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in range(n - 1, -1, -1):  # children come behind their parents
        own = sums[node]
        children[node] += own["n_children"]
        leaves[node] = (leaves[node] + own["n_leaves"]) or 1
        saved[node] += own["saved_tokens"] + (own["n_convs"] - 1) * own["words"]
        if node:
            above = skeleton.parent[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]

    def run(batches):
        def rows(done):
            names = ["skeleton", "ends_sha256"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.string()))], names=names)

        node, digest = None, None
        for batch in batches:
            done = []
            for at, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at == node:
                    digest.update(b"," + ends)
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(ends)
            if done:
                yield rows(done)
        if node is not None:
            yield rows([(node, digest.hexdigest())])

    # a digest goes through its bytes in order; its task reads pieces of PIECE_IDS ids
    digests = (
        parts.filter(F.col("kind") == ENDS).select("skeleton", "shard", "piece", "ends").repartition("skeleton")
        .sortWithinPartitions("skeleton", "shard", "piece").select("skeleton", "ends")
        .mapInArrow(run, "skeleton long, ends_sha256 string")
    )
    rows = [(k, sums[k]["least"], skeleton.depth[k], sums[skeleton.parent[k]]["least"] if k else None, sums[k]["n_convs"],
             children[k], leaves[k], saved[k]) for k in range(n)]
    schema = "skeleton long, " + ", ".join(f"{c} long" for c in NODE[:-1])
    found = parts.sparkSession.createDataFrame(rows, schema).join(digests, "skeleton", "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of (conv_id, path, words): conv_id (smallest member),
    depth, parent_conv_id (of the node above, null for the root), n_convs (members),
    n_children, n_leaves, saved_tokens and ends_sha256 (conv_ids that end at the node).

    The root, of depth 0, is there if any conversation is. A path may be empty; its
    conversation ends at the root. Equal paths are members of the same nodes. ``paths`` is
    read twice and should be a written table; ``shards`` is the number of ranges, by
    default that of shuffle partitions.
    """
    spark = paths.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters = splitters_of(paths, n)
    skeleton = Skeleton([path for path, _ in splitters])
    shared = spark.sparkContext.broadcast((splitters, skeleton))

    def deal(batches):
        borders = shared.value[0]
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            shard = pa.array([bisect.bisect_right(borders, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=["path", "words", "conv_id", "shard"])

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(k).to_pylist() for k in range(4)))

        out = []
        for shard, group in itertools.groupby(rows(), lambda row: row[3]):
            for _ in trie_shard((row[:3] for row in group), shared.value[1], shard, out):
                if len(out) >= ROWS:
                    yield _batch(out)
                    out.clear()
        if out:
            yield _batch(out)

    dealt = paths.select("path", "words", "conv_id").mapInArrow(
        deal, "path array<binary>, words array<int>, conv_id long, shard int")
    dealt = dealt.repartitionById(len(splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    made = materialize(dealt.mapInArrow(run, _SHARD), "trie")
    top = materialize(_finished_skeleton(skeleton, made.filter(F.col("kind") != FINISHED)), "trie-skeleton")
    above = top.select("skeleton", F.col("conv_id").alias("above"))  # a row per node of the broadcast skeleton
    finished = made.filter(F.col("kind") == FINISHED).join(F.broadcast(above), "skeleton", "left")
    finished = finished.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return finished.select(*NODE).unionByName(top.select(*NODE))

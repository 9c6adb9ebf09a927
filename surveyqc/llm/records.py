"""Token ids as length-delimited binary records with an offset index.

Documents are dealt out by ranges of their id, and each task writes one file: every record
is framed as the payload's length (8 bytes), the masked checksum of the length (4), the
payload, and the masked checksum of the payload (4), all little-endian. A payload is a
byte that tells whether there is an id, the id (8), the bytes per token (1), and the tokens.
The index has one row per record with file, offset and length, so records can be read in
any order. The checksum is zlib's CRC-32, masked by rotation and addition.
"""

from __future__ import annotations

import io
import json
import os
import re
import string
import struct
import uuid
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyqc.llm.bpe import CACHED_CHARS, UnitTable
from surveyqc.llm.common import chunks, texts_of, worker_cache
from surveyqc.sources.scratch import materialize, shared_folder

_MASK = 0xA282EAD8
#: Signs that are one pre-token behind a word; contractions have ', special tokens have <.
_SIGNS = re.sub("['<]", "", string.punctuation)
#: Letters and digits, as every Unicode version has it.
_WORD_ENDS = frozenset(string.ascii_letters + string.digits + "".join(map(chr, range(0xC0, 0x250)))) - {"\u00d7", "\u00f7"}
#: Layout of a frame's front and end and of a payload's front.
_HEAD, _TAIL, _RECORD = "<QI", "<I", "<BqB"
#: Bytes read from a file at once.
READ_BYTES = 4 << 20
#: Files that a task which reads by the index holds open.
OPEN_FILES = 64
#: Characters of units that are encoded as one text.
JOINED_CHARS = 1 << 16


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join([size, struct.pack(_TAIL, masked(size)), payload, struct.pack(_TAIL, masked(payload))])


def packed(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """The payload; raises if an id has more than ``width`` bytes."""
    if len(ids) and int(ids.max()) >> (8 * width):
        raise ValueError(f"token id {ids.max()} does not fit {width} bytes")
    return struct.pack(_RECORD, doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()


def unpacked(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, doc_id, width = struct.unpack_from(_RECORD, payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_RECORD))
    return (doc_id if known else None), ids.astype("<u4")


def payload_at(stream, what: str) -> bytes | None:
    """The next payload, None at the end; raises if a checksum does not hold."""
    head = stream.read(struct.calcsize(_HEAD))
    if not head:
        return None
    size, check = struct.unpack(_HEAD, head)
    if masked(head[:8]) != check:
        raise ValueError(f"{what}: the length of a record is damaged")
    payload = stream.read(size)
    tail = stream.read(struct.calcsize(_TAIL))
    if len(payload) < size or len(tail) < struct.calcsize(_TAIL) or masked(payload) != struct.unpack(_TAIL, tail)[0]:
        raise ValueError(f"{what}: a record is damaged")
    return payload


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _encoder(model: str) -> UnitTable:
    """Ids by the tokenizers library as it is called by default: the string of a special
    token within a text is that token. A text is cut at single spaces so that what repeats is
    encoded once (see UnitTable), and encoded whole if it has runs of white space."""
    cache = worker_cache("tokenizers")
    key = zlib.crc32(model.encode())
    if key not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(model)
        cache[key] = WordTable(tokenizer, json.loads(model))
    return cache[key]


class WordTable(UnitTable):
    """Of units that are not known, the signs behind a word and the lines are taken off where
    the byte-level pattern starts a pre-token; what is left is kept as units are."""

    def __init__(self, tokenizer, made_of: dict):
        super().__init__(partial(_packed_units, tokenizer, _spaced_ids(tokenizer)), lambda text: [text])
        before = made_of.get("pre_tokenizer") or {}
        self.by_line = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not any(made_of.get(x) for x in ("normalizer", "truncation", "padding"))
            and all("<" in token["content"] for token in made_of.get("added_tokens") or ())
        )

    def parts(self, unit: str) -> list[str]:
        """Parts that end where a pre-token does. A single line feed is one, as a unit has no
        other white space but the space at its front."""
        if "\n" in unit:
            if "<" in unit or "\n\n" in unit:
                return [unit]
            lines = unit.split("\n")
            parts = self.parts(lines[0]) if lines[0] else []
            for line in lines[1:]:
                first, *others = self.parts(line) if line else [""]
                parts += ["\n" + first, *others]
            return parts
        core = unit.rstrip(_SIGNS)
        if len(core) == len(unit) or not core or core[-1] not in _WORD_ENDS or "<" in core:
            return [unit]
        return [core, unit[len(core):]]

    def packed_cut(self, units: list[str]) -> list[bytes]:
        if not self.by_line:
            return self.packed(units)
        split = list(map(self.parts, units))
        ids: dict[str, bytes | None] = {}
        for parts in split:
            if len(parts) > 1:
                for part in parts:
                    if part not in ids:
                        ids[part] = self.young.get(part) or self.old.get(part)
            else:
                ids[parts[0]] = None
        missing = [part for part, known in ids.items() if known is None]
        ids.update(zip(missing, self.packed(missing)))
        self.young.update((part, ids[part]) for part in missing if len(part) <= CACHED_CHARS)
        return [ids[parts[0]] if len(parts) == 1 else b"".join(map(ids.__getitem__, parts)) for parts in split]


def _packed_units(tokenizer, spaced: np.ndarray, units: list[str]) -> list[bytes]:
    return [ids.tobytes() for ids in _encoded_units(tokenizer, spaced, units)]


def _spaced_ids(tokenizer) -> np.ndarray:
    """Whether the token of an id starts with a space or a line feed, which byte-level vocabularies
    write as U+0120 and U+010A."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    spaced = np.zeros(max(vocabulary.values()) + 1, bool)
    spaced[[i for token, i in vocabulary.items() if token[0] in "\u0120\u010a"]] = True
    return spaced


def _encoded_units(tokenizer, spaced: np.ndarray, units: list[str]) -> list[np.ndarray]:
    """Ids of each unit. Those with one space or line feed, at their front, and no white space at
    their end are encoded many at a time as one text: it starts a pre-token there, whatever is
    before it, so a unit's ids go from one token with such a sign in front to the next."""
    out: list[np.ndarray | None] = [None] * len(units)
    own, lot, held = [], [], 0

    def one_by_one(places):
        found = tokenizer.encode_batch_fast([units[i] for i in places], add_special_tokens=False)
        for i, encoding in zip(places, found):
            out[i] = np.array(encoding.ids, "<u4")

    def together(places):
        text = "".join([units[i] for i in places])
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = [*np.flatnonzero(spaced[ids]).tolist(), len(ids)]
        if ends[0] or len(ends) != len(places) + 1:  # a vocabulary that joins across spaces
            return one_by_one(places)
        for i, start, end in zip(places, ends, ends[1:]):
            out[i] = ids[start:end]

    for i, unit in enumerate(units):
        if max(unit.rfind(" "), unit.rfind("\n")) or unit[-1].isspace():
            own.append(i)
            continue
        lot.append(i)
        held += len(unit)
        if held >= JOINED_CHARS:
            together(lot)
            lot, held = [], 0
    if lot:
        together(lot)
    one_by_one(own)
    return out


def write_records(
    docs: DataFrame, model_path: str, folder: str, end_id: int = 0, id_col: str = "doc_id",
    text_col: str = "text", width: int = 2,
) -> DataFrame:
    """Write all documents in ascending order of id, each with ``end_id`` at its end; the
    index of what was written: file, position, offset, length and n_tokens.

    Rows with one id are ordered by a hash of their text, a null id comes first. A null
    text counts as empty: its record has the end id alone. ``width`` is the bytes of a
    token. A file is written under a name of its own and then renamed, so a task that runs
    twice leaves one whole file.
    """
    with open(model_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")
    )
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def run(batches):
        store, root = _place(folder)
        name = f"part-{TaskContext.get().partitionId():06d}.rec"
        draft = f"{root}/.{name}.{uuid.uuid4().hex}"
        units, out, offset, position = _encoder(shared.value), None, 0, 0
        for chunk in chunks(batches, 2):
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(draft)
            index = []
            texts = [t.decode() for t in texts_of(chunk.column(2))]
            for doc_id, raw in zip(chunk.column(0).to_pylist(), units.encode(texts)):
                ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
                record = framed(packed(doc_id, ids, width))
                out.write(record)
                index.append((name, position, offset, len(record), len(ids)))
                offset += len(record)
                position += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*index)], names=["file", "position", "offset", "length", "n_tokens"]
            )
        if out is not None:
            out.close()
            store.move(draft, f"{root}/{name}")

    schema = "file string, position long, offset long, length long, n_tokens long"
    return materialize(rows.mapInArrow(run, schema), "records-index")


def read_records(spark: SparkSession, index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, read from the files: one task
    reads a file from its front and checks every frame. ``start`` is the number of ids in
    all records before."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    files = materialize(files, "records-files")
    n = max(files.count(), 1)

    def run(batches):
        store, root = _place(folder)
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                with store.open_input_stream(f"{root}/{name}", buffer_size=READ_BYTES) as stream:
                    while (payload := payload_at(stream, name)) is not None:
                        doc_id, ids = unpacked(payload)
                        rows.append((doc_id, first, len(ids), zlib.crc32(ids.tobytes())))
                        first += len(ids)
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    return files.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_shuffled(
    spark: SparkSession, index: DataFrame, folder: str, seed: int = 0, tasks: int | None = None
) -> DataFrame:
    """doc_id and ids of every record in an order that ``seed`` decides, read through the
    index: records are dealt out at random, and each is read at its own offset.

    One row per index row. A part of the index, such as a sample or some files, reads just
    those records. A damaged frame raises.
    """
    order = F.xxhash64("file", "position", F.lit(seed))
    places = index.select("file", "offset", "length", order.alias("o"))
    places = places.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "o").sortWithinPartitions("o")

    def run(batches):
        store, root = _place(folder)
        open_files = {}
        try:
            for batch in batches:
                rows = []
                for name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if name not in open_files:
                        if len(open_files) >= OPEN_FILES:
                            open_files.pop(next(iter(open_files))).close()
                        open_files[name] = store.open_input_file(f"{root}/{name}")
                    frame = io.BytesIO(open_files[name].read_at(length, offset))
                    payload = payload_at(frame, f"{name} at {offset}")
                    if payload is None:
                        raise ValueError(f"{name} at {offset}: there is no record")
                    rows.append(unpacked(payload))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"],
                )
        finally:
            for file in open_files.values():
                file.close()

    return places.mapInArrow(run, "doc_id long, ids array<long>")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.int64()) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def record_round_trip(docs: DataFrame, model_path: str, folder: str | None = None) -> DataFrame:
    """Write the documents' ids as records and read them back; one row per row."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/surveyqc/records-{uuid.uuid4().hex}"
    return read_records(spark, write_records(docs, model_path, folder), folder)

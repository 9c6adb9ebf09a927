"""Chat formatting by incremental black-box rendering.

A template is a function from messages to text, of which nothing else is known. For a
conversation the first turn is rendered, the first two, and so on; what an output has beyond
the one before is the new turn's span. An output that does not begin with the one before
shows that the template rewrites history; such a conversation is marked with the turn at
which that happened and has no spans. Where the text lies within its span is found from the
outside as well: the last turn is rendered with two short probes, and what both outputs have
in front of and behind the probe frames the text.

The loss mask is the list of the spans of the texts of the trained roles. ``n`` turns cost
``n`` renderings, so work grows with the square of a conversation's length, as it must for a
function that only takes whole conversations. A conversation is held by one task.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqc.llm.common import bounded, worker_cache

Message = tuple[str, str]

#: Characters of output that a task returns at once, unless one conversation has more.
OUT_CHARS = 4 << 20
#: Texts by which a turn's frame is told: they differ in the first and the last character.
PROBES = ("0", "1")


@dataclass(frozen=True)
class Template:
    """``render`` gives the text of a list of (role, text), ``read`` takes it apart again,
    and ``plain`` undoes the escapes within a piece of text."""

    render: Callable[[Sequence[Message]], str]
    read: Callable[[str], list[Message]]
    plain: Callable[[str], str]


# ---- the marked template --------------------------------------------------------------
# A turn is ``### role: text</turn>`` and a line feed. A backslash stands in front of every
# backslash, of every # in a run of three or more and of the slash in </turn>, in roles also
# of colons. So neither mark can come up within a text, and reading is exact.

_CONTROL = re.compile(r"\\|#(?=##)|(?<=##)#|(?<=#)#(?=#)|(?<=<)/(?=turn>)")
_ROLE_CONTROL = re.compile(r"[\\#:]|(?<=<)/(?=turn>)")
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): (.*?)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _turn(role: str, text: str) -> str:
    return f"### {_ROLE_CONTROL.sub(lambda m: chr(92) + m[0], role)}: {escape(text)}</turn>\n"


def render_marked(messages: Sequence[Message]) -> str:
    """A conversation is rendered once per turn, so short turns are kept for the next time."""
    known = bounded(worker_cache("chat turns"), 4096)
    out = []
    for message in messages:
        turn = known.get(message)
        if turn is None:
            turn = _turn(*message)
            if len(turn) < 4096:
                known[message] = turn
        out.append(turn)
    return "".join(out)


def read_marked(formatted: str) -> list[Message]:
    """The messages; raises if the text is not what :func:`render_marked` writes."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return found


MARKED = Template(render_marked, read_marked, unescape)


# ---- spans ----------------------------------------------------------------------------


def _shared(a: str, b: str) -> int:
    """Length of what both begin with."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def locate(render: Callable, messages: Sequence[Message], trained: frozenset[str]):
    """(output, spans, trained text spans, first turn whose rendering changed what was
    before it or None). Spans are (start, end) in code points, one per turn."""
    before, spans, masks, rewritten = "", [], [], None
    for n in range(1, len(messages) + 1):
        out = render(messages[:n])
        if not out.startswith(before):
            rewritten = n - 1
            break
        spans.append((len(before), len(out)))
        role = messages[n - 1][0]
        if role in trained:
            # the frame: what outputs of two probes share at either side behind the old output
            one, two = (render([*messages[: n - 1], (role, probe)]) for probe in PROBES)
            start = _shared(one, two)
            tail = min(_shared(one[::-1], two[::-1]), len(out) - start)
            if start < len(before) or out[:start] != one[:start] or out[len(out) - tail :] != one[len(one) - tail :]:
                raise ValueError(f"the text of turn {n - 1} has no fixed frame")
            masks.append((start, len(out) - tail))
        before = out
    if rewritten is not None:
        return render(messages), None, None, rewritten
    return before, spans, masks, None


def format_conversations(
    turns: DataFrame, template: Template = MARKED, trained: Sequence[str] = ("assistant",),
) -> DataFrame:
    """One row per conv_id: formatted, spans and loss_spans (arrays of start and end in code
    points, end exclusive) and rewritten_turn (position of the first turn whose rendering
    changed earlier output; then both arrays are null. Null if none did).

    Turns are ordered by turn, null first, equal ones by role and text; a null role or text
    counts as empty, and repeated rows are repeated turns. Rows with a null conv_id are one
    conversation. Other columns are not read.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    trained = frozenset(trained)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        def messages():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())

        def given(out):
            ids, texts, spans, masks, rewritten = zip(*out)
            spans, masks = ([x and [dict(start=s, end=e) for s, e in x] if x is not None else None for x in xs]
                            for xs in (spans, masks))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, span), pa.array(masks, span),
                 pa.array(rewritten, pa.int32())], names=["conv_id", "formatted", "spans", "loss_spans", "rewritten_turn"])

        out, size = [], 0
        for conv, group in itertools.groupby(messages(), lambda m: m[0]):
            found = locate(template.render, [m[1:] for m in group], trained)
            out.append((conv, *found))
            size += len(found[0])
            if size > OUT_CHARS:
                yield given(out)
                out, size = [], 0
        if out:
            yield given(out)

    spans = "array<struct<start:bigint,end:bigint>>"
    return rows.select("conv_id", "role", "text").mapInArrow(
        run, f"conv_id long, formatted string, spans {spans}, loss_spans {spans}, rewritten_turn int")


def read_conversations(formatted: DataFrame, template: Template = MARKED) -> DataFrame:
    """Take formatted conversations apart: conv_id, messages (role, text), loss_texts (of
    the loss spans, without escapes; null if there are none known) and formatted_chars."""
    message = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            messages = [[dict(role=r, text=t) for r, t in template.read(text)] for text in texts]
            loss = [
                None if spans is None else [template.plain(text[s["start"] : s["end"]]) for s in spans]
                for text, spans in zip(texts, batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(messages, message), pa.array(loss, pa.list_(pa.string())),
                 pa.array(list(map(len, texts)), pa.int64())],
                names=["conv_id", "messages", "loss_texts", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(
        run, "conv_id long, messages array<struct<role:string,text:string>>, loss_texts array<string>, formatted_chars long")

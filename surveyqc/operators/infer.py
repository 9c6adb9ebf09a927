"""Running a supplied classifier over cases and reading its answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from surveyqc.functions import json as J
from surveyqc.functions import responses as R
from surveyqc.functions.codes import empty_codes, sorted_codes
from surveyqc.functions.text import strip_ws
from surveyqc.operators.once import with_once
from surveyqc.operators.prompts import Prompts
from surveyqc.sources.scratch import materialize

# Takes (system, user) prompts of one batch, returns one answer each, in order; an
# answer may be an exception instance.
Classifier = Callable[[list[tuple[str, str]]], list]

ANSWER = "raw string, error string, timestamp string"


#: Characters of a text that decide which range it falls into.
HEAD_CHARS = 64


def _head(df: DataFrame, name: str) -> Column:
    """What is no more than a text's start sorts texts as far as it goes."""
    return F.substring(name, 1, HEAD_CHARS) if df.schema[name].dataType == StringType() else F.col(name)


def assign_batches(df: DataFrame, order: list[str], batch_size: int) -> DataFrame:
    """Add ``batch_id``: contiguous batches of ``batch_size`` in the given order, from 1.

    Rows are range-partitioned by the order columns, of texts only by the first
    ``HEAD_CHARS`` characters, so no narrative is sampled to the driver; whole texts order
    the rows inside a partition. They are written once with their partition and their
    position in it. The number of rows before each partition is a running sum
    over one row per partition; that small table (as many rows as partitions) is joined
    back. No task sees more than its own partition, and as partition and position are
    stored, a lost executor cannot renumber rows.
    """
    placed = materialize(
        df.repartitionByRange(*[_head(df, c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "batches",
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    row = F.col("__offset") + F.col("__pos")
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn("batch_id", F.floor(row / batch_size) + 1)
        .drop("__part", "__pos", "__offset")
    )


def asker(system: str, model: Classifier, call_size: int = 32) -> Callable[[Column], Column]:
    """A function of user prompts that asks ``model``: one ``ANSWER`` each, in Arrow batches."""

    # everything the tasks need is local to this function and travels with it, so the
    # library has to be installed on the driver only
    def answers_of(prompts: list[tuple[str, str]]) -> list:
        """One answer or exception per prompt, whatever the model does."""
        try:
            answers = list(model(prompts))
            if len(answers) == len(prompts):
                return answers
            problem: Exception = ValueError(f"{len(answers)} answers for {len(prompts)} prompts")
        except Exception as e:
            problem = e
        if len(prompts) == 1:
            return [problem]
        return [a for p in prompts for a in answers_of([p])]

    @F.pandas_udf(ANSWER)
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for start in range(0, len(texts), call_size):
                part = texts.iloc[start : start + call_size].fillna("")
                for a in answers_of([(system, t) for t in part]):
                    failed = not isinstance(a, str)
                    rows.append((None if failed else a, str(a) if failed else None,
                                 datetime.now().isoformat()))
            yield pd.DataFrame(rows, columns=["raw", "error", "timestamp"])

    return ask.asNondeterministic()


def answer_columns(answer: str = "__answer") -> dict[str, Column]:
    """What :func:`asker` answered, by the names that records have."""
    names = {"raw_response": "raw", "call_error": "error", "timestamp": "timestamp"}
    return {name: F.col(f"{answer}.{c}") for name, c in names.items()}


def classify(
    cases: DataFrame,
    prompts: Prompts,
    model: Classifier,
    text_col: str = "observacion",
    key: list[str] | None = None,
    parallelism: int | None = None,
    call_size: int = 32,
) -> DataFrame:
    """Ask ``model`` once per case; adds ``raw_response``, ``call_error``, ``timestamp``.

    Only the rendered user prompt crosses to Python, in Arrow batches. ``parallelism`` bounds the
    concurrent callers by spreading the cases over that many partitions by ``key``,
    which should identify a case. Answers cost money and need not repeat: write the
    result once and go on from the written table.
    """
    if parallelism:
        cases = cases.repartition(parallelism, *[F.col(c) for c in key or ["id"]])
    ask = asker(prompts.system, model, call_size)
    asked = cases.withColumn("__answer", ask(prompts.user_prompt(F.col(text_col))))
    return asked.withColumns(answer_columns()).drop("__answer")


def parse_responses(
    df: DataFrame, raw_col: str = "raw_response", accept_array: bool = False
) -> DataFrame:
    """Add ``parsed`` (codes, reasoning, failed). Each text is parsed once; the search
    for an embedded payload runs only where the text is not valid JSON."""
    text = strip_ws(F.coalesce(F.col(raw_col), F.lit("")))
    if accept_array:
        text = R.as_object(text)
    t, v = F.col("__text"), F.col("__v")
    span = F.when(v.isNull(), R.embedded_object(t))
    return (
        with_once(df, __text=text)
        .transform(lambda d: with_once(d, __v=J.strict_variant(t)))
        .withColumn("__span", F.nullif(span, F.lit("")))
        .withColumn("__e", J.strict_variant(F.col("__span")))
        .transform(lambda d: with_once(d, parsed=R.parse_response(t, v, F.col("__e"))))
        .drop("__text", "__v", "__span", "__e")
    )


def to_records(answered: DataFrame, accept_array: bool = False) -> DataFrame:
    """Response records from classified cases: one per case in any event. A failed call
    or an answer of impossible shape gives an error record without codes whose expected
    codes stay as they came in."""
    df = parse_responses(answered, accept_array=accept_array)
    failed = F.col("call_error").isNotNull() | F.col("parsed.failed")
    reasoning = F.when(
        F.col("call_error").isNotNull(), F.concat(F.lit(R.FAILED), F.col("call_error"))
    ).otherwise(F.col("parsed.reasoning"))
    return (
        df.withColumn("error", failed)
        .withColumn(
            "expected_codes",
            F.when(F.col("error"), F.col("expected_codes")).otherwise(
                sorted_codes(F.col("expected_codes"))
            ),
        )
        .withColumn(
            "predicted_codes",
            F.when(F.col("error"), empty_codes()).otherwise(F.col("parsed.codes")),
        )
        .withColumn("razonamiento_modelo", reasoning)
        .withColumn(
            "raw_response", F.when(F.col("error"), F.lit("")).otherwise(F.col("raw_response"))
        )
        .drop("parsed", "call_error")
    )


def case_totals(cases: DataFrame) -> DataFrame:
    """Cases to classify and the original rows behind them."""
    return cases.agg(
        F.count(F.lit(1)).alias("cases"),
        F.coalesce(F.sum(F.size("ids_delito_originales")), F.lit(0)).alias("original_rows"),
    )


def batch_stats(records: DataFrame) -> DataFrame:
    """Cases, original rows and errors per batch."""
    return records.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("cases"),
        F.sum(F.size("ids_delito_originales")).alias("original_rows"),
        F.count_if(F.coalesce("error", F.lit(False))).alias("errors"),
    )

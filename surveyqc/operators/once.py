"""Keep costly expressions from being repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A filter on a plain computed column is pushed below its projection and takes a copy
    of the whole expression along for each mention. Columns made by a generator stay
    where they are, so a text is cleaned and a response parsed once, however often
    later steps mention it. The generator emits one row per row, within the same
    code-generated stage.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(made)))

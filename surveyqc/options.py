"""Options that steer a review run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

COMPLEX = "complex"
SIMPLE = "simple"


@dataclass(frozen=True)
class SurveyOptions:
    """Column layout, thresholds and modes.

    ``mode`` is ``"complex"`` (the row id is built from several columns, equal
    narratives of one household are grouped) or ``"simple"`` (one id column,
    one case per row, the code column is optional).
    """

    mode: str = COMPLEX
    id_components: tuple[str, ...] = ("HOGAR", "P201", "ID", "P424_ID")
    id_col: str = "ID"
    text_col: str = "OBS_400A"
    code_col: str | None = "P424_ID"

    min_chars: int = 21
    min_words: int = 5

    pattern_min_count: int = 10
    pattern_min_percent: float = 5.0
    whole_word_patterns: bool = False

    batch_size: int = 350

    # "error" raises on a fractional id part such as 1.5, "null" treats it as missing
    on_fractional: str = "error"
    # "id": of several narratives under one base key the last one (by text order) is reviewed;
    # "id_text": every narrative is reviewed on its own
    result_key: str = "id"
    # a join key is spread over several tasks from this many rows on, if it also has more
    # than a fair share of all rows
    hot_key_rows: int = 1_000_000
    # read a bare JSON array of classifications as a valid response
    accept_array: bool = False

    def __post_init__(self) -> None:
        if self.mode not in (COMPLEX, SIMPLE):
            raise ValueError(f"unknown mode: {self.mode!r}")
        if self.on_fractional not in ("error", "null"):
            raise ValueError(f"unknown on_fractional: {self.on_fractional!r}")
        if self.result_key not in ("id", "id_text"):
            raise ValueError(f"unknown result_key: {self.result_key!r}")
        if self.mode == COMPLEX and self.code_col is None:
            raise ValueError("complex mode needs a code column")
        if not 0 < self.pattern_min_percent <= 100:
            raise ValueError("pattern_min_percent must be in (0, 100]")
        if self.batch_size < 1:
            raise ValueError("batch_size must be positive")

    @classmethod
    def simple(cls, **kwargs) -> "SurveyOptions":
        """Defaults for a flat table: one id column and no code column."""
        defaults = dict(mode=SIMPLE, id_col="ID", text_col="DESCRIPCION1", code_col=None)
        return cls(**{**defaults, **kwargs})

    @property
    def required_columns(self) -> list[str]:
        if self.mode == COMPLEX:
            names = [*self.id_components, self.text_col, self.code_col]
        else:
            names = [self.id_col, self.text_col, self.code_col]
        return list(dict.fromkeys(n for n in names if n is not None))


def check_columns(df: DataFrame, names: list[str]) -> None:
    """Raise before any job starts if a required column is absent."""
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise ValueError(f"required columns not found: {missing}")

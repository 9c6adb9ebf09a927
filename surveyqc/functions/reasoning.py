"""Clean-up of the model's general reasoning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyqc.functions.text import WS, strip_ws

# The closing point and the stock sentences that carry no information
FINAL_POINT = "Construyo el JSON final"
STOCK_SENTENCES = (
    r"No hay más eventos delictivos mencionados en la observación\.",
    r"No hay otros eventos delictivos mencionados en la observación.*",
    r"No hay más eventos delictivos en la observación\.",
)

_POINT_5 = rf"(?sU){WS}*5\.{WS}*{FINAL_POINT}.*"
_POINT_4 = rf"(?sU){WS}*4\.{WS}*.*"
_STOCK = rf"(?iud)\A(?:{'|'.join(STOCK_SENTENCES)})\z"  # d: only \n ends a line


def clean_reasoning(c: Column) -> Column:
    """Cut the final-JSON point, and point 4 if all it says is a stock sentence."""
    text = F.regexp_replace(c, _POINT_5, "")
    point_4 = strip_ws(F.regexp_extract(text, r"(?s)4\.(.*)", 1))
    cut = F.when(
        F.regexp_like(point_4, F.lit(_STOCK)), F.regexp_replace(text, _POINT_4, "")
    ).otherwise(text)
    return strip_ws(cut)

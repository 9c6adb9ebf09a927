import random
import re

from pyspark.sql import functions as F

from surveyqc.functions import text as T
from surveyqc.functions.reasoning import clean_reasoning

CASES = [
    (None, ""),
    ("P.201 ITEM 3: le robaron el celular", "le robaron el celular"),
    ("Capítulo i - le robaron", "le robaron"),
    ("a" * 60 + " 2024", "a" * 60 + " 2024"),
    ("a" * 59 + "1234", "a" * 59 + "234"),
    ("...¿Qué pasó?", "Qué pasó?"),
    ("a\tb", "a\tb"),
    ("a \t b", "a b"),
    ("pé i ó", "pé ó"),
    ("P_ robo", "robo"),
    ("P_robo", "P_robo"),
    ("P.ITEM uno", "uno"),
    ("p p. i  preg. x", "x"),
    ("robo (P) en I.", "robo () en ."),
    ("\x1cropa  vieja ", "ropa vieja"),
    ("١٢٣ tres", "tres"),
    ("--- --- ---", ""),
    ("āP robo", "P robo"),  # one word; its first letter is cut as no Spanish letter
    ("…P robo", "robo"),
    ("😀 PGTA 😀 robo", "robo"),
]


def test_clean_text(one):
    assert one(T.clean_text, [g for g, _ in CASES]) == [w for _, w in CASES]


def test_clean_text_agrees_with_unicode_rules(one):
    """Random texts against the same rules put in terms of Python's own regex engine."""
    marks = re.compile(
        r"\b(?:(?:%s)\.?|%s)\b" % ("|".join(T.DOTTED_MARKS), "|".join(T.PLAIN_MARKS)), re.I
    )

    def python_says(s):
        s = (re.sub(r"\d", "", s[:60]) + s[60:]).strip()
        s = re.sub("^[^%s0-9]+" % T.LETTERS, "", marks.sub("", s))
        return re.sub(r"\s{2,}", " ", s).strip()

    rng = random.Random(7)
    pieces = list("PpIiaé.,_-1٣ \t\n\x1c ā²Ⅷ…\u0301") + [
        "ITEM", "preg.", "PGR", "capítulo", "alternativa", "pgta ", " i ", "P. ", "  ", "😀",
    ]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(3000)]
    got = one(T.clean_text, texts)
    wrong = [(t, g, python_says(t)) for t, g in zip(texts, got) if g != python_says(t)]
    assert wrong == []


def test_gate(one):
    five = "uno dos tres cuatro c"
    assert len(five) == 21
    values = [five, five[:-2] + "tro", "uno dos tres cuatro 12345", "--- --- --- --- --- --- ---",
              "", "unodostrescuatrocinco seis", "a1b2c3d4e" + "!" * 20, "x" * 50_000]
    wanted = [True, False, False, False, False, False, True, False]
    assert one(T.passes_gate, values) == wanted


def test_opening_words(one):
    values = ["", "  ", None, "uno", " uno\tdos ", "uno dos\n tres cuatro", "straße x"]
    assert one(T.opening_words, values) == [
        [], [], [], ["UNO"], ["UNO", "DOS"], ["UNO", "DOS", "TRES"], ["STRASSE", "X"],
    ]


def test_syllables(one):
    values = ["SEÑORA", "CASA", "123", "", "Y", "AGÜERO", "INFORMANTE"]
    assert one(T.syllables, values) == [3, 2, 0, 0, 1, 3, 4]


def test_capitalize_first(one):
    assert one(T.capitalize_first, ["", "él", "1 a", "Ya", "ßx"]) == ["", "Él", "1 a", "Ya", "SSx"]


REASONING = [
    ("1. A. 5. Construyo el JSON final con todo\ny más", "1. A."),
    ("1. A. 5. Otra cosa", "1. A. 5. Otra cosa"),
    ("1. A. 4. No hay más eventos delictivos en la observación.", "1. A."),
    ("1. A. 4. NO HAY MÁS EVENTOS DELICTIVOS EN LA OBSERVACIÓN.", "1. A."),
    ("1. A. 4. No hay más eventos delictivos mencionados en la observación. 5. Construyo el JSON final", "1. A."),
    ("1. A. 4. No hay otros eventos delictivos mencionados en la observación, salvo", "1. A."),
    ("1. A. 4. No hay otros eventos delictivos mencionados en la observación\rfin", "1. A."),
    ("1. A. 4. No hay otros eventos delictivos mencionados en la observación\nfin",
     "1. A. 4. No hay otros eventos delictivos mencionados en la observación\nfin"),
    ("1. A. 4. No hay más eventos delictivos en la observación. Sí.",
     "1. A. 4. No hay más eventos delictivos en la observación. Sí."),
    ("En 2014. No hay más eventos delictivos en la observación.", "En 201"),
    (" x ", "x"),
    (None, None),
]


def test_clean_reasoning(one):
    got = one(clean_reasoning, [g for g, _ in REASONING])
    assert got == [w for _, w in REASONING]


def test_strip_and_collapse(one):
    values = ["　 a \x1f b\n", "a\tb", "a  b", "", "\n"]
    assert one(T.collapse_ws, values) == ["a b", "a b", "a b", "", ""]
    assert one(T.strip_ws, values) == ["a \x1f b", "a\tb", "a  b", "", ""]
    assert one(lambda c: F.length(T.as_text(c)), [None]) == [0]

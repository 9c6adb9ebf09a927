"""Text cleaning, quality gate and opening-phrase expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as str.strip() and \s of the survey scripts take it
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\s\x1c-\x1f]"  # to be used under (?U)
WORD = r"[\p{L}\p{N}_]"  # no combining marks, but all kinds of digits

# Questionnaire marks that interviewers type into the narrative
DOTTED_MARKS = ("P", "PREG", "PGR", "PRG")
PLAIN_MARKS = ("P_", "ITEM", "ITEN", "CAPÍTULO", "PGTA", "I", "ALTERNATIVA")
LETTERS = "A-Za-zÁÉÍÓÚÜÑáéíóúüñ"
DIGIT_FREE_HEAD = 60

VOWELS = "aeiouáéíóúü"
SPANISH_LETTERS = "a-záéíóúüñ"


def _not_latin1(excluded: Callable[[str], bool]) -> str:
    """A class of all characters but the Latin-1 ones given.

    Unicode-aware classes cost far more per character than this plain table. Patterns
    put it first, as a coarse test that lets nearly every character fail at once, and
    settle the rest with the exact class.
    """
    return "[^" + "".join(f"\\x{i:02x}" for i in range(256) if excluded(chr(i))) + "]"


_MAYBE_SPACE = _not_latin1(lambda c: not c.isspace())
_MAYBE_BREAK = _not_latin1(lambda c: c.isalnum() or c == "_")
_MAYBE_MARK = _not_latin1(lambda c: c.upper() not in {m[0] for m in DOTTED_MARKS + PLAIN_MARKS})

# a mark is a whole word; it takes a dot along if a word follows at once, and only there
# can the next mark follow without a character in between
_MARKS = (
    rf"({_MAYBE_BREAK})(?={_MAYBE_MARK})(?iu:(?:(?<!{WORD})(?:"
    rf"(?:{'|'.join(DOTTED_MARKS)})(?:\.(?={WORD})|(?!{WORD}))"
    rf"|(?:{'|'.join(PLAIN_MARKS)})(?!{WORD})))+)"
)
_RUNS = rf"(?={_MAYBE_SPACE}{_MAYBE_SPACE})(?U:{WS}{{2,}})"
_RUNS_AND_ODD = rf"(?={_MAYBE_SPACE})(?U:{WS}{{2,}}|(?! ){WS})"


def strip_ws(c: Column) -> Column:
    """Trim Unicode whitespace on both ends (``F.trim`` alone takes only blanks)."""
    return F.trim(c, F.lit(WHITESPACE))


def collapse_ws(c: Column) -> Column:
    """Every whitespace run becomes one blank; both ends are trimmed."""
    return strip_ws(F.regexp_replace(c, _RUNS_AND_ODD, " "))


def as_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def clean_text(c: Column) -> Column:
    """Clean a narrative: drop digits of the head, questionnaire marks, leading
    punctuation and repeated whitespace. Null becomes the empty string."""
    t = as_text(c)
    head = F.regexp_replace(F.substring(t, 1, DIGIT_FREE_HEAD), r"(?U)\d", "")
    t = strip_ws(F.concat(head, F.substr(t, F.lit(DIGIT_FREE_HEAD + 1))))
    t = F.regexp_replace(F.concat(F.lit(" "), t), _MARKS, "$1")
    t = F.regexp_replace(t, f"^[^{LETTERS}0-9]+", "")  # takes the blank in front as well
    return strip_ws(F.regexp_replace(t, _RUNS, " "))


def passes_gate(cleaned: Column, min_chars: int = 21, min_words: int = 5) -> Column:
    """Long enough and with enough alphabetic runs; never null.

    The word test is one anchored, possessive match that stops at the n-th run,
    so a long narrative is not scanned to its end.
    """
    t = F.coalesce(cleaned, F.lit(""))
    runs = (
        rf"^[^{LETTERS}]*+(?:[{LETTERS}]++[^{LETTERS}]++){{{max(min_words - 1, 0)}}}[{LETTERS}]"
        if min_words > 0
        else "^"
    )
    return (F.length(t) >= min_chars) & F.regexp_like(t, F.lit(runs))


def opening_words(c: Column, max_words: int = 3) -> Column:
    """The first words in upper case. The match ends with the last word wanted, so the
    length of the narrative does not matter."""
    word = r"[^\s\x1c-\x1f]+"
    opening = rf"(?U)^{WS}*((?:{word}{WS}+){{0,{max_words - 1}}}{word})"
    found = F.regexp_extract(as_text(c), opening, 1)
    words = F.split(found, f"(?U){WS}+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.upper(w))


def syllables(word: Column) -> Column:
    """Vowel groups of the word; 0 if it has no Spanish letter, else at least 1."""
    w = F.regexp_replace(F.lower(word), f"[^{SPANISH_LETTERS}]", "")
    groups = F.regexp_count(w, F.lit(f"[{VOWELS}]+"))
    return F.when(w == "", F.lit(0)).otherwise(F.greatest(F.lit(1), groups))


def capitalize_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))

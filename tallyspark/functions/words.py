"""Word rules. Each turns a line into an array of words in one native expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.numeric import _col

# Patterns and characters of the three word rules.
# White space as Python's strip and split see it, for Java and RE2 patterns alike.
WHITE = r"\x09-\x0d\x1c-\x20\x{85}\p{Z}"
BLANKS = f"[{WHITE}]+"
NOT_BLANK = f"[^{WHITE}]"
DIGIT = "[0-9]"
LETTERS = r"^\p{L}+$"
ASCII_LETTERS = "^[a-zA-Z]+$"
DROPPED_MARKS = ".,!?:'"


def _without_digits(line: Column) -> tuple[Column, Callable[[Column], Column]]:
    return F.split(line, BLANKS), lambda w: (F.length(w) > 0) & ~w.rlike(DIGIT)


def _letters(line: Column) -> tuple[Column, Callable[[Column], Column]]:
    return F.split(F.replace(line, F.lit("."), F.lit("")), BLANKS), lambda w: w.rlike(LETTERS)


def _ascii_lower(line: Column) -> tuple[Column, Callable[[Column], Column]]:
    cleaned = F.lower(F.translate(line, DROPPED_MARKS, ""))
    return F.split(cleaned, BLANKS), lambda w: w.rlike(ASCII_LETTERS)


# "no_digits": at least one character, no digit; case and punctuation count.
# "letters":   full stops removed, then letters of any script only.
# "ascii":     common marks removed, lower case, a-z only.
WORD_RULES = {"no_digits": _without_digits, "letters": _letters, "ascii": _ascii_lower}


def word_rule(line, rule: str = "no_digits"):
    """(array of candidates, test for a candidate) of a named rule."""
    return WORD_RULES[rule](_col(line))


def not_blank(line) -> Column:
    return _col(line).rlike(NOT_BLANK)

"""Text normalisation that behaves like Python's ``str.strip`` and ``str.title``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the white-space characters stripped (those of \s: blank, tab, newline,
# vertical tab, form feed, carriage return).
WHITESPACE = " \t\n\u000b\f\r"


def strip_all(col: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (plain ``trim`` only removes
    blanks). A character-set trim, no regular expression."""
    return F.trim(F.col(col) if isinstance(col, str) else col, F.lit(WHITESPACE))


def title_case(col: Column | str) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` only starts words after blanks; Python's title case also starts one
    after digits and punctuation ("don't" -> "Don'T", "12x" -> "12X"). Split the text
    into alternating runs of letters and non-letters and capitalise each run.
    """
    c = F.col(col) if isinstance(col, str) else col
    # initcap starts a word only after a blank. Put a blank after every non-letter,
    # capitalise, then drop exactly those blanks: left to right, each non-letter is
    # followed by its own inserted blank, so the pairs line up. Built-in, codegen'd
    # string functions only (no per-element lambda).
    spaced = F.regexp_replace(c, r"(\P{L})", "$1 ")
    return F.regexp_replace(F.initcap(spaced), r"(\P{L}) ", "$1")


def is_missing_text(col: Column | str) -> Column:
    """True for null, empty and the text a null becomes after ``str(...).title()``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | (c == "") | (c == "Nan")

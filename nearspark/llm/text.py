"""Small column helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space as text and as the inside of a character class.
WHITE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words of ASCII letters, digits and all non-ASCII characters.
SYMBOL_CLASS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def whole(text: Column) -> Column:
    """The text, a null as the empty one."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """``A``-``Z`` lower-cased and nothing else; the plain JVM function where it does the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def split_words(text: Column, between: str = SPACE_CLASS) -> Column:
    """Maximal runs of characters outside the class ``between``; an empty array without any."""
    return F.filter(F.split(text, f"[{between}]+"), lambda w: w != "")

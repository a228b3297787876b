"""Column expressions on words and lines, shared by the native operators.

A word is a match of ``[^\\x20\\x09-\\x0D]+``; a null text has none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def lower_ascii(value: Column) -> Column:
    """A-Z to lower case, nothing else; values without other characters take the JVM's ASCII path."""
    return F.when(F.octet_length(value) == F.char_length(value), F.lower(value)).otherwise(F.translate(value, UPPER, LOWER))

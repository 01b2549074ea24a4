"""Splitting text the way Java's ``String.split`` does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(text: Column, sep: str) -> Column:
    """``text.split(sep)`` of Java for a one-character separator.

    Leading and inner empty fields are kept, trailing empty fields are
    dropped, an empty text gives one empty field and a text made only of
    separators gives none.  Spark's ``split`` keeps trailing empties, so the
    trailing separators are trimmed first.  A null text gives null.
    """
    if len(sep) != 1:
        raise ValueError("one-character separator expected")
    trimmed = F.rtrim(text) if sep == " " else F.rtrim(text, F.lit(sep))
    pattern = sep if sep == " " or sep.isalnum() else "\\" + sep
    return (F.when(text == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, pattern)))


def java_split_words(text: Column) -> Column:
    """Words of ``text`` as Java's ``String.split(" ")`` yields them: the
    separator is the single space character, so tabs and newlines stay inside
    words and case is kept (``rtrim`` without a trim string removes only
    0x20).  A null text gives a null array, which ``explode`` drops."""
    return java_split(text, " ")

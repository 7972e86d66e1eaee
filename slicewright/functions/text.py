"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank at the ends of a parameter value.
BLANKS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Finds a character that is none of BLANKS; stops at the first one.
_SOLID = r"(?U)[^\s\x1c-\x1f]"

# Fixed value: a log message keeps letters, digits, underscores, blanks and / : #
MESSAGE_NOISE = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f/:#]"


def strip(text: Column) -> Column:
    """Remove blanks of every kind (not only spaces) from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for NULL and for text made of blanks only."""
    return text.isNull() | ~text.rlike(_SOLID)


def blank_to_null(text: Column) -> Column:
    """NULL for blank text; any other text comes back untouched."""
    return F.when(~is_blank(text), text)


def null_to_empty(text: Column) -> Column:
    """Stripped text, empty for NULL."""
    return F.coalesce(strip(text), F.lit(""))


def null_word_to_empty(text: Column) -> Column:
    """Stripped text, empty for NULL and for the word "null" in any case."""
    return F.when(F.lower(text) == "null", F.lit("")).otherwise(null_to_empty(text))


def clean_message(text: Column) -> Column:
    """Message reduced to the characters a log line may hold; NULL when blank."""
    return blank_to_null(F.regexp_replace(blank_to_null(text), MESSAGE_NOISE, ""))


def whole_number(text: Column) -> Column:
    """Integer value of a text, NULL when it is not one."""
    return text.try_cast("bigint")

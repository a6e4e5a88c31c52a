"""Text cleaning and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column) -> Column:
    """Each character that is not an ASCII letter, digit or white space becomes one blank; lower case."""
    return F.lower(F.regexp_replace(text, r"[^a-zA-Z0-9\s]", " "))


def tokens(cleaned: Column, min_length: int = 2) -> Column:
    """White-space separated tokens of at least ``min_length`` characters."""
    return F.filter(F.split(F.lower(cleaned), r"\s+"), lambda t: F.length(t) >= min_length)


def is_blank(text: Column) -> Column:
    """NULL, empty or nothing but white space."""
    return F.coalesce(text.rlike(r"^\s*$"), F.lit(True))


def missing(text: Column) -> Column:
    """NULL or empty."""
    return F.coalesce(text == "", F.lit(True))

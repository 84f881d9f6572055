"""Title and line text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_title(title: Column) -> Column:
    """Words of ASCII letters and digits, one space apart; null becomes ''.

    Blanking special characters and then collapsing white space leaves one
    space for every run of other characters, so one pass over the text does
    both. ``Alnum`` is ASCII only; the same class spelled as a negated union of
    ranges makes the threads of an executor contend for a type check inside
    Java 17's regular expressions, and eight of them run no faster than one.
    """
    return F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"\P{Alnum}+", " "))


def has_text(title: Column) -> Column:
    """True where at least one character is not Unicode white space."""
    return title.rlike(r"\P{IsWhite_Space}")


def not_blank_line(line: Column) -> Column:
    """As ``has_text``, with the ASCII separators counted as blank too."""
    return line.rlike(r"[^\p{IsWhite_Space}\x1c-\x1f]")


def title_preview(title: Column, width: int = 80) -> Column:
    """Log form of a title: its first ``width`` characters or a stand-in."""
    return F.substring(F.coalesce(title, F.lit("<no title>")), 1, width)

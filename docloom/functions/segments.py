"""Cutting a text at the matches of a pattern and rewriting one side of the cut, all in Column expressions.

``split`` and ``regexp_extract_all`` see the same matches, so outside parts and matches interleave to the text again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def outside(text: Column, pattern: str | Column) -> Column:
    """The parts between matches: one more than there are matches."""
    return F.split(text, pattern, -1)


def matches(text: Column, pattern: str | Column) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))


def interleaved(parts: Column, found: Column) -> Column:
    """``parts`` and, after each but the last, what was found there."""
    return F.array_join(F.zip_with(parts, found, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")


def map_outside(text: Column, pattern: str | Column, change: Callable[[Column], Column]) -> Column:
    return interleaved(F.transform(outside(text, pattern), change), matches(text, pattern))


def map_matches(text: Column, pattern: str | Column, change: Callable[[Column], Column]) -> Column:
    """The text with each match replaced by ``change`` of it; no character of the result is special."""
    return interleaved(outside(text, pattern), F.transform(matches(text, pattern), change))

"""Scalar text operators over Markdown, as Column expressions.

Patterns are in the JVM's dialect: ``(?d)`` so that only a line feed ends a line, ``(?U)`` where word and space classes are
those of Unicode, ``\\z`` for the end of the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .segments import map_outside

# Literal replacements, in the order in which they apply.
SYMBOL_ESCAPES = {"/C0069": "©", "/C0109": "µ", "/C0043": "=", "/C0042": "-", "/C0324": "/", "/C0087": "Ω"}
PRIVATE_GLYPHS = {"\uf0a3": "≤", "\uf0b3": "≥", "\uf0b1": "±", "\uf0b0": "°", "\uf0d6": "×", "\uf0fc": "✓", "\uf06c": "•", "\uf0a8": "•", "\uf0b7": "•"}
MOJIBAKE = "Â"
PHRASES = {
    "Patent -Marking": "Patent-Marking",
    "Patent - Marking": "Patent-Marking",
    "technical - documentation": "technical-documentation",
    "technical -documentation": "technical-documentation",
    "as -is": "as-is",
    "read - only": "read-only",
    "write - only": "write-only",
    "read - write": "read-write",
    "ultra-lowpower": "ultra-low power",
    "crossconduction": "cross conduction",
    "Power-dowm": "Power-down",
    "fourlayer": "four-layer",
    "12-bitreadout": "12-bit readout",
    "OUTPUT_EN - ABLE_N": "OUTPUT_ENABLE_N",
}
# Patterns.
FENCE = r"(?s)(```.*?```|~~~.*?~~~)"
LIST_BULLET = r"(?md)^([ \t]*[-*+][ \t]+)•[ \t]+"
BULLET = r"(?md)^([ \t]*)•[ \t]+"
PAGE_HEADER = r"(?mdi)^[ \t]{0,3}#{1,6}[ \t]+(?:AND\d{5,}/D|CONFIDENTIAL AND PROPRIETARY[^\n]*)[ \t]*\n?"
TRAILING_PAGE = r"(?U)(?<!\n)\n{2,}+\d{1,4}[ \t]*+\z"
#: Six lines and more of nothing but numbers. A line may start after any line separator and ends in a line feed or the text. All
#: repeats are possessive: nothing that follows them could use what they give back, and the engine then loops instead of recursing.
NUMBER_RUN = r"(?:(?<![^\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029])[ \t]*+[0-9][0-9|.,:; \t-]*+(?:\n|\z)){6,}+"
EQUATION_LABEL = r"(?id)(?<!\[)\b(?:Equation|Eqn|Eq\.)\s*\(?\d+\)?[.:]?[ \t]*\r?\n+(?:[ \t]*[^\n\[\]]{0,80}\r?\n+)?\z"
EQUATION_LOOKBACK = 200
GUID_LINE = r"(?md)^[ \t]*GUID-[0-9A-Fa-f-]+(?:-low)?\.(?:gif|png|jpe?g|svg)[ \t]*$\n?"
SUB_SUP_GAP = r"(?U)(\w)[ \t]+(<su[bp]>)"
ALT_LIMIT, ALT_DEFAULT = 300, "Image"


def strip(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s++|(?<!\s)\s++\z", "")


def replaced(text: Column, table: dict[str, str]) -> Column:
    for old, new in table.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def clean_symbols(text: Column) -> Column:
    """Symbol escapes, private-use glyphs, stray lead bytes and known phrases."""
    text = replaced(text, SYMBOL_ESCAPES)
    text = F.translate(text, "".join(PRIVATE_GLYPHS), "".join(PRIVATE_GLYPHS.values()))
    return replaced(F.replace(text, F.lit(MOJIBAKE), F.lit("")), PHRASES)


def bullets(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, LIST_BULLET, "$1"), BULLET, "$1- ")


def strip_page_headers(text: Column) -> Column:
    return F.regexp_replace(text, PAGE_HEADER, "")


def strip_trailing_pageno(text: Column) -> Column:
    return F.regexp_replace(text, TRAILING_PAGE, "\n")


def drop_number_runs(text: Column) -> Column:
    return F.regexp_replace(text, NUMBER_RUN, "")


def clean_segment(text: Column) -> Column:
    return drop_number_runs(strip_trailing_pageno(strip_page_headers(bullets(clean_symbols(text)))))


def outside_fences(text: Column, change) -> Column:
    return map_outside(text, FENCE, change)


def clean_markdown(text: Column) -> Column:
    """All cleanups, outside fenced code."""
    return outside_fences(text, clean_segment)


def alt_sanitize(alt: Column) -> Column:
    """A usable alternative text, or null."""
    text = strip(alt)
    bad = (text == "") | text.startswith("<bound method") | text.contains("data:image") | (F.length(text) > ALT_LIMIT)
    return F.when(~bad, F.regexp_replace(text, r"(?U)\s+", " "))


def alt_of_list(alts: Column) -> Column:
    return alt_sanitize(F.array_join(alts, " "))


def preceded_by_equation_label(md: Column, start: Column) -> Column:
    """Whether an equation's label ends right before character ``start`` (from 0), in the characters looked back at."""
    low = F.greatest(F.lit(0), start - EQUATION_LOOKBACK)
    return F.substring(md, low + 1, start - low).rlike(EQUATION_LABEL)


def wrap_latex(latex: Column) -> Column:
    block = latex.contains("\\\\") | latex.contains("\\begin") | latex.contains("\n")
    return F.when(block, F.concat(F.lit("\n$$\n"), latex, F.lit("\n$$\n"))).otherwise(F.concat(F.lit("$"), latex, F.lit("$")))


def drop_guid_lines(md: Column) -> Column:
    return F.regexp_replace(md, GUID_LINE, "")


def strip_eqno(latex: Column) -> Column:
    return strip(F.regexp_replace(latex, r"(?d)\\eqno\b.*\z", ""))


def equation_number(text: Column) -> Column:
    """The first run of digits once white space is gone, or null."""
    return F.nullif(F.regexp_extract(F.regexp_replace(text, r"(?U)\s+", ""), r"(\d+)", 1), F.lit(""))


def equation_tag(latex: Column, number: Column) -> Column:
    return F.when(number.isNull(), latex).otherwise(F.concat(latex, F.lit(" \\tag{"), number, F.lit("}")))


def subsup_tighten(md: Column) -> Column:
    return F.regexp_replace(md, SUB_SUP_GAP, "$1$2")

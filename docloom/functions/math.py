"""Normalising LaTeX in math spans, and rewriting plain subscripts by the variables of a document's equations."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .segments import interleaved, map_matches, matches, outside

# Patterns, commands and the shortest subscript.
KEPT = r"(?dU)(\\[A-Za-z]++)(\s)(?:\s|\\(?=\n|\z))*+(?=\p{L})|(\\[A-Za-z]+|\\.|[^\\\s])|\s+|\\"
FONT_COMMANDS = ("\\mathsf", "\\mathrm")
THIN_SPACE = r"(?U)(?<=\d)\\,(?=\d)"
DISPLAY = r"(?sd)\$\$(?:(?!\n[ \t]*\n).)+?\$\$"
INLINE = r"(?<!\$)\$(?!\$)[^$\n]+?\$(?!\$)"
SPAN = rf"{DISPLAY}|{INLINE}"
LOOKS_LIKE_MATH = r"[\\_^{}]"
VARIABLE = r"([A-Za-z])_\{([A-Za-z][A-Za-z0-9]*)\}"
SHORTEST_SUBSCRIPT = 2


def latex_despace(latex: Column) -> Column:
    """Without white space, but for one blank between a command and a letter; a backslash that escapes nothing goes.

    One scan over tokens keeps what its groups hold; a second turns the kept white space, which follows a letter, into blanks.
    """
    kept = F.regexp_replace(latex, KEPT, "$1$2$3")
    return F.regexp_replace(kept, r"(?U)(?<=[A-Za-z])\s", " ")


_BRACES = re.compile("([{}])")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def without_command(text: str, command: str) -> str:
    """``text`` with the groups of ``command`` replaced by their contents, read once from left to right.

    The stack holds an entry for each open brace: None, or where in the output a group of the command began and what was left to
    read. A blank keeps a command that then runs into the group's first letter apart. A group that is never closed stays, with
    all that follows it, as it was.
    """
    pieces = _BRACES.split(text)
    out: list[str] = []
    stack: list[tuple[int, int] | None] = []
    begun = [0]  # where the open groups of the command began
    for at, piece in enumerate(pieces):
        if piece == "{" and len(out) - len(command) >= begun[-1] and "".join(out[-len(command) :]) == command:
            del out[-len(command) :]
            stack.append((len(out), at))
            begun.append(len(out))
            k = len(out)
            while k and out[k - 1] in _LETTERS:
                k -= 1
            if 0 < k < len(out) and out[k - 1] == "\\" and pieces[at + 1][:1].isalpha():
                out.append(" ")
        elif piece == "{":
            stack.append(None)
            out.append(piece)
        elif piece == "}" and stack and stack.pop() is not None:
            begun.pop()
        else:
            out.extend(piece)
    first = next((x for x in stack if x is not None), None)
    if first is None:
        return "".join(out)
    return "".join(out[: first[0]]) + command + "".join(pieces[first[1] :])


def unwrap(text: str) -> str:
    """``text`` without font commands, their groups' contents in place."""
    for command in FONT_COMMANDS:
        before = None
        while text != before and command + "{" in text:  # contents may form the command anew
            before, text = text, without_command(text, command)
    return text


@F.pandas_udf(T.StringType())
def _unwrap(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else unwrap(t))


def latex_unwrap(latex: Column) -> Column:
    """Font commands unwrapped; balanced groups need a parser, so texts that hold one go to Python, the others do not."""
    return F.when(latex.contains("\\mathsf{") | latex.contains("\\mathrm{"), _unwrap(latex)).otherwise(latex)


def latex_thinspace(latex: Column) -> Column:
    return F.regexp_replace(latex, THIN_SPACE, "")


@F.pandas_udf(T.StringType())
def _unwrap_spans(texts: pd.Series) -> pd.Series:
    display = re.compile(r"(\$\$(?:(?!\n[ \t]*\n).)+?\$\$)", re.S)
    inline = re.compile(r"((?<!\$)\$(?!\$)[^$\n]+?\$(?!\$))")

    def spans(text: str, pattern) -> str:
        parts = pattern.split(text)
        parts[1::2] = [unwrap(x) if re.search(LOOKS_LIKE_MATH, x) else x for x in parts[1::2]]
        return "".join(parts)

    return texts.map(lambda t: t if t is None else spans(spans(t, display), inline))


def _each_span(md: Column, pattern: str, width: int, change) -> Column:
    mark = "$" * width

    def one(span: Column) -> Column:
        inner = F.substring(span, F.lit(width + 1), F.length(span) - 2 * width)
        return F.when(inner.rlike(LOOKS_LIKE_MATH), F.concat(F.lit(mark), change(inner), F.lit(mark))).otherwise(span)

    return map_matches(md, pattern, one)


def normalize_math(docs: DataFrame, column: str = "md") -> DataFrame:
    """Display spans first, then inline ones; spans that do not look like math stay. Python only for documents with font commands.

    A projection for each pass: a pass reads its text twice, and nested passes would double it each time.
    """
    for pattern, width in ((DISPLAY, 2), (INLINE, 1)):
        docs = docs.withColumn(column, _each_span(F.col(column), pattern, width, latex_despace))
    fonts = F.col(column).contains("\\mathsf{") | F.col(column).contains("\\mathrm{")
    docs = docs.withColumn(column, F.when(fonts, _unwrap_spans(F.col(column))).otherwise(F.col(column)))
    for pattern, width in ((DISPLAY, 2), (INLINE, 1)):
        docs = docs.withColumn(column, _each_span(F.col(column), pattern, width, latex_thinspace))
    return docs


def math_spans(md: Column) -> Column:
    return matches(md, SPAN)


def equation_vars(md: Column) -> Column:
    """The distinct (base, sub) of the document's math spans."""
    found = F.flatten(F.transform(math_spans(md), lambda s: F.arrays_zip(F.regexp_extract_all(s, F.lit(VARIABLE), F.lit(1)).alias("base"), F.regexp_extract_all(s, F.lit(VARIABLE), F.lit(2)).alias("sub"))))
    found = F.transform(found, lambda v: F.struct(v["base"].alias("base"), v["sub"].alias("sub")))
    return F.array_distinct(F.filter(found, lambda v: F.length(v["sub"]) >= SHORTEST_SUBSCRIPT))


def dictionary(variables: Column, joint: str) -> Column:
    """variable's plain spelling → its inline formula."""
    entries = F.transform(variables, lambda v: F.struct(F.concat(v["base"], F.lit(joint), v["sub"]).alias("key"), F.concat(F.lit("$"), v["base"], F.lit("_{"), v["sub"], F.lit("}$")).alias("value")))
    return F.map_from_entries(entries)


def sub_to_latex(md: Column, known: Column) -> Column:
    """``X<sub>s</sub>`` as the variable's formula; ``known`` is ``dictionary(variables, '<sub>')``, a column."""
    one = lambda found: F.coalesce(F.element_at(known, F.replace(found, F.lit("</sub>"), F.lit(""))), found)
    return map_matches(md, r"(?U)\w<sub>\w+</sub>", one)


def flat_pattern(variables: Column) -> Column:
    """A pattern of all variables' plain spellings, longest first."""
    ordered = F.array_sort(variables, lambda a, b: F.length(b["sub"]) - F.length(a["sub"]))
    return F.concat(F.lit("(?<![A-Za-z])(?:"), F.array_join(F.transform(ordered, lambda v: F.concat(v["base"], F.lit("[ \\t]?"), v["sub"])), "|"), F.lit(")(?![A-Za-z0-9])"))


def flat_sub(md: Column, known: Column, pattern: Column) -> Column:
    """Plain spellings outside math, in one pass; ``known`` is ``dictionary(variables, '')``, both best as columns."""
    change = lambda part: map_matches(part, pattern, lambda m: F.coalesce(F.element_at(known, F.regexp_replace(m, r"\s+", "")), m))
    return interleaved(F.transform(outside(md, SPAN), change), matches(md, SPAN))


def standardize_subscripts(docs: DataFrame, column: str = "md") -> DataFrame:
    """Subscripts that the document's equations define, as their formulas. The dictionary is made once a document: it is a column that is read more than once, so no lambda makes it anew."""
    docs = docs.withColumn("__vars", equation_vars(F.col(column)))
    docs = docs.withColumns({"__sub": dictionary(F.col("__vars"), "<sub>"), "__flat": dictionary(F.col("__vars"), ""), "__pattern": flat_pattern(F.col("__vars"))})
    docs = docs.withColumn(column, F.when(F.size("__sub") > 0, sub_to_latex(F.col(column), F.col("__sub"))).otherwise(F.col(column)))
    docs = docs.withColumn(column, F.when((F.size("__flat") > 0) & (F.length("__pattern") > 0), flat_sub(F.col(column), F.col("__flat"), F.col("__pattern"))).otherwise(F.col(column)))
    return docs.drop("__vars", "__sub", "__flat", "__pattern")

"""Layout metadata of extractors, which spell their fields in several ways, as one schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import alt_sanitize, equation_number, equation_tag, strip_eqno

from .vision import formula_parts

# The spellings, in order of preference.
SPELLINGS = {
    "l": ("l", "left", "x0"),
    "t": ("t", "top", "y0"),
    "r": ("r", "right", "x1"),
    "b": ("b", "bottom", "y1"),
    "page": ("page_no", "page", "page_number"),
    "alt": ("alt", "alt_text", "text", "caption_text", "name", "label"),
    "coord_system": ("coord_origin", "coord_system", "origin"),
}
BBOX = "struct<l:double,t:double,r:double,b:double>"


def first_of(json: Column, field: str, prefix: str = "$") -> Column:
    """The first spelling of ``field`` that is not null in a JSON text."""
    return F.coalesce(*(F.get_json_object(json, f"{prefix}.{x}") for x in SPELLINGS[field]))


def bbox_normalize(json: Column, prefix: str = "$") -> Column:
    """A struct of four doubles, or null if one of them is missing or no number."""
    parts = {k: first_of(json, k, prefix).try_cast("double") for k in "ltrb"}
    whole = F.lit(True)
    for x in parts.values():
        whole = whole & x.isNotNull()
    return F.when(whole, F.struct(*(x.alias(k) for k, x in parts.items())))


def page_number(json: Column, prefix: str = "$") -> Column:
    return first_of(json, "page", prefix).try_cast("int")


def item_alt(json: Column) -> Column:
    return alt_sanitize(first_of(json, "alt"))


def is_picture(json: Column) -> Column:
    """Whether a layout item has an image or is called one."""
    named = F.lower(F.concat_ws(" ", F.get_json_object(json, "$.class"), F.get_json_object(json, "$.label")))
    return F.get_json_object(json, "$.image").isNotNull() | named.contains("picture") | named.contains("image")


def layout_images(items: Column) -> Column:
    """The metadata of the pictures among ``items``, an array of JSON texts; the first provenance of each counts."""
    one = lambda x: F.struct(item_alt(x).alias("alt"), page_number(x, "$.prov[0]").alias("page"), bbox_normalize(x, "$.prov[0].bbox").alias("bbox"), first_of(x, "coord_system", "$.prov[0].bbox").alias("coord_system"))
    return F.transform(F.filter(items, is_picture), one)


def is_formula(kind: Column, label: Column) -> Column:
    """Whether a layout item is text that the extractor calls a formula."""
    return F.coalesce((F.lower(kind) == "text") & (F.lower(label) == "formula"), F.lit(False))


def with_formulas(items: DataFrame, formula: Callable[[Column], Column], number: Callable[[Column], Column] | None = None) -> DataFrame:
    """``items`` (kind, label, image, text, ...) with the text of formulas as LaTeX, tagged with the number that stands beside them.

    ``formula`` and ``number`` (the recognised text of a number's image) are functions of an image column. An image that the
    model gives nothing for keeps its text; other items stay as they are.
    """
    asked = is_formula(F.col("kind"), F.col("label"))
    rows = items.withColumn("__parts", formula_parts(F.when(asked, F.col("image"))))
    rows = rows.withColumns({"__latex": strip_eqno(formula(F.col("__parts.formula"))), "__number": equation_number(number(F.col("__parts.number"))) if number else F.lit(None).cast("string")})
    new = F.when(asked & F.col("image").isNotNull(), equation_tag(F.col("__latex"), F.col("__number")))
    return rows.withColumn("text", F.coalesce(new, F.col("text"))).drop("__parts", "__latex", "__number")

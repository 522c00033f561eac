"""Text and JSON-cell expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strict JSON only; a cell that does not parse becomes NULL.
LENIENT_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
# A cell that does not parse fails the job.
STRICT_JSON = {"mode": "FAILFAST", "allowSingleQuotes": "false"}

NAMED_TAGS = "array<struct<id:bigint,name:string>>"


def is_label(text: Column, label: str) -> Column:
    """Case- and padding-insensitive equality with a label; NULL stays NULL."""
    return F.lower(F.trim(text)) == label.lower()


def has_token(text: Column, token: str) -> Column:
    """True when a comma list holds the token as a whole element.

    Case and white space around the element are ignored; NULL counts as an
    empty list.
    """
    element = rf"(?i)(?:^|,)\s*{re.escape(token)}\s*(?:,|\z)"
    return F.coalesce(text, F.lit("")).rlike(element)


def comma_elements(text: Column) -> Column:
    """Trimmed elements of a comma list."""
    return F.transform(F.split(text, ","), lambda element: F.trim(element))


def named_tags(cell: Column, strict: bool = False) -> Column:
    """JSON list of ``{id, name}`` objects as an array of structs."""
    return F.from_json(cell, NAMED_TAGS, STRICT_JSON if strict else LENIENT_JSON)


def _elements(cell: Column) -> Column:
    """Elements of a JSON list, of whatever types; NULL for any other or unreadable text."""
    return F.try_variant_get(F.try_parse_json(cell), "$", "array<variant>")


def tag_names(cell: Column) -> Column:
    """Names of the objects in a JSON list; elements without a name give NULL."""
    return F.transform(_elements(cell), lambda e: F.try_variant_get(e, "$.name", "string"))


def id_tags(cell: Column) -> Column:
    """Numbers of a JSON list as whole numbers, rounded; elements that are no number become NULL."""
    return F.transform(_elements(cell), lambda e: F.round(F.try_variant_get(e, "$", "decimal(38,9)"), 0).cast("bigint"))


def clean_name(text: Column, default: str) -> Column:
    """Name without padding; blank and NULL become the default."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))

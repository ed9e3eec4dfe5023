"""Reading extractor answers: JSON text with a nested flag object and a keyword list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.functions.scalars import col

# Every member is kept as text first: the kind of `features` and `keywords` is itself a finding.
TEXT_MAP = "map<string,string>"


def parse_members(c: Column | str) -> Column:
    """Object members as text; NULL when the text is not a JSON object."""
    text = F.trim(col(c))
    return F.when(text.startswith("{"), F.from_json(text, TEXT_MAP))


def member(members: Column, name: str) -> Column:
    return F.try_element_at(members, F.lit(name))


def is_object(text: Column) -> Column:
    return F.startswith(F.trim(text), F.lit("{"))


def flag_map(text: Column) -> Column:
    """Nested object as text values; empty map when it is missing or not an object."""
    empty = F.from_json(F.lit("{}"), TEXT_MAP)
    return F.coalesce(F.when(is_object(text), F.from_json(text, TEXT_MAP)), empty)

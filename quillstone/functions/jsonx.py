"""Typed reads of JSON text: Column to Column, all native.

A JSON null and an absent key are SQL null; the string ``"null"`` counts as null only
where a document is kept as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"


def json_string(doc: str | Column, path: str) -> Column:
    return F.get_json_object(doc, f"$.{path}")


def json_decimal(doc: str | Column, path: str) -> Column:
    """Exact for JSON numbers and strings alike; text extraction would go through a double.

    A value that is no decimal is an error, as in a cast; a text that is no JSON has no value.
    """
    value = F.try_variant_get(F.try_parse_json(doc), f"$.{path}", DECIMAL)
    text = F.try_variant_get(F.try_parse_json(doc), f"$.{path}", "string")
    return F.coalesce(value, text.cast(DECIMAL))


def json_int(doc: str | Column, path: str) -> Column:
    return json_string(doc, path).cast("bigint")


def json_bool(doc: str | Column, path: str) -> Column:
    return json_string(doc, path).cast("boolean")


def json_timestamp(doc: str | Column, path: str) -> Column:
    """Naive UTC; an offset in the text is applied first, which a direct cast would drop."""
    return F.to_utc_timestamp(json_string(doc, path).cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")


def json_object(doc: str | Column, path: str) -> Column:
    """A part of the document as text, keys in their order; null for JSON null."""
    return F.nullif(json_string(doc, path), F.lit("null"))


def json_string_array(doc: str | Column, path: str) -> Column:
    return F.from_json(json_string(doc, path), "array<string>")


def array_has(items: str | Column, value) -> Column:
    return F.array_contains(items, value)

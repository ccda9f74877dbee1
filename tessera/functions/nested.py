"""Nested values: JSON text, VARIANT and struct paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.columns import as_column as _col


def parse_doc(c) -> Column:
    """A4: JSON text to VARIANT; malformed text gives NULL."""
    return F.try_parse_json(_col(c))


def json_field(c, path: str, type_name: str) -> Column:
    """A value at a JSON path of a VARIANT column (see ``parse_doc``), typed;
    NULL when absent or not castable."""
    return F.try_variant_get(_col(c), path, type_name)


def to_json_text(c) -> Column:
    """A5: a nested value (struct, map, array or VARIANT) to JSON text."""
    return F.to_json(_col(c))


def field(path: str) -> Column:
    """NULL-safe nested struct access (``a.b.c``): a NULL parent
    gives NULL instead of an error."""
    return F.col(path)

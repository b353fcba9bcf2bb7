"""Schemas that can be declared before there is a session."""

from __future__ import annotations

from pyspark.sql.types import StructType


def flat_schema(**columns: str) -> StructType:
    """Nullable columns by name and simple type name."""
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema

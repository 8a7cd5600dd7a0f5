"""Row <-> JSON text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_json(df: DataFrame, columns=None) -> Column:
    """the whole row (or ``columns``) as one JSON object; nulls omitted."""
    cols = columns or df.columns
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]))


def parse_json(c, schema) -> Column:
    """JSON text to a struct; malformed text gives null fields."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, schema, {"mode": "PERMISSIVE"})

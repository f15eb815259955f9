"""Semi-structured values as Variant columns: parsed once when they are stored, read by path without parsing again.

A Variant keeps the types of what it holds, so a number at a path is compared as a number. Text that is no JSON has no
Variant (null), as a value that is absent has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parsed(column: str) -> Column:
    """The Variant of JSON text; null where the text is no JSON."""
    return F.try_parse_json(column)


def packed(*columns: Column) -> Column:
    """Typed columns as one Variant object, nulls included as nulls."""
    return F.to_variant_object(F.struct(*columns))


def at(column: str, path: str, kind: str = "string") -> Column:
    """Value at a path of a Variant, null where it is absent or of another kind."""
    return F.try_variant_get(column, path, kind)


def shape(rows: DataFrame, column: str) -> str:
    """The type that all values of the column have together; one aggregation, combined on the map side."""
    return rows.agg(F.schema_of_variant_agg(column).alias("shape")).first().shape


def variant_columns(rows: DataFrame) -> list[str]:
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, T.VariantType)]

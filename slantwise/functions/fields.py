"""Group keys and dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "unknown"


def subset_field(df: DataFrame, field: str, meta_col: str = "subset_meta") -> Column | None:
    """Group key called ``field``: a column, else an entry of the metadata column.

    Resolved from the schema when the plan is built. Missing values become
    ``unknown``; ``None`` is returned when the table has neither.
    """
    if field in df.columns:
        return F.coalesce(F.col(field).cast("string"), F.lit(UNKNOWN))
    if meta_col not in df.columns:
        return None
    kind = df.schema[meta_col].dataType
    if isinstance(kind, T.MapType):
        value = F.try_element_at(F.col(meta_col), F.lit(field)).cast("string")
    elif isinstance(kind, T.VariantType):
        path = "$['" + field.replace("'", "\\'") + "']"
        value = F.try_variant_get(F.col(meta_col), path, "string")
    elif isinstance(kind, T.StructType):
        value = F.col(meta_col)[field].cast("string") if field in kind.names else F.lit(None).cast("string")
    else:
        raise TypeError(f"{meta_col} must be a map, struct or variant, not {kind.simpleString()}")
    return F.coalesce(value, F.lit(UNKNOWN))


def coerce_date(value: Column, formats: Sequence[str] = ()) -> Column:
    """Timestamp of a date string, or null; ISO first, then any listed format."""
    attempts = [F.try_to_timestamp(value)]
    attempts += [F.try_to_timestamp(value, F.lit(pattern)) for pattern in formats]
    return F.coalesce(*attempts)

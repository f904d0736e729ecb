"""The greatest row of a group, for columns of any type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def orderable(df: DataFrame, name: str) -> Column:
    """The column itself, or its JSON text where the type has no order (maps)."""
    if is_orderable(df.schema[name].dataType):
        return F.col(name)
    return F.to_json(F.struct(name))


def greatest_row(
    rows: DataFrame, by: list[str], order: list[str], payload: list[str]
) -> DataFrame:
    """Per group the whole row with the greatest (order, payload)."""
    if all(is_orderable(rows.schema[c].dataType) for c in payload):
        best = F.max(F.struct(*order, *payload))
    else:
        ties = [orderable(rows, c).alias(f"t{i}") for i, c in enumerate(payload)]
        best = F.max_by(F.struct(*order, *payload), F.struct(*order, *ties))
    return rows.groupBy(*by).agg(best.alias("_best")).select(*by, "_best.*")

"""A space-filling order of rows by several columns.

Each column's values are cut into ranges of about equal numbers of rows, and the bits of
the range numbers are interleaved, the highest first. Rows that are close on the curve
are close in every column, so a stretch of it covers a small range of each. The cuts come
from one pass that keeps a bounded sketch; they decide only where a row lies, so it does
not matter that they are approximate. A value that is frequent covers several ranges and has
the number of the last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.search import count_not_above

MOST_BITS = 10
# A long has 63 bits for the position.
POSITION_BITS = 62
# So many bytes of a text fit into a positive long.
TEXT_BYTES = 7


def with_curve_position(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Append a row's place on the curve through ``columns``; nulls lie with the least values."""
    if len(columns) < 2 or len(set(columns)) < len(columns):
        raise ValueError("an interleaved order needs two or more different columns")
    bits = min(MOST_BITS, POSITION_BITS // len(columns))
    cut = df.withColumn("_cuts", _cuts(df, columns, (1 << bits) - 1))
    return cut.withColumn(name, _interleave(F.col("_cuts"), df, columns, bits)).drop("_cuts")


def _cuts(df: DataFrame, columns: Sequence[str], ranges: int) -> Column:
    """Per column the values at equal shares of its rows, ascending; a frequent value stands there repeatedly."""
    shares = [i / (ranges + 1) for i in range(1, ranges + 1)]
    found = [
        F.percentile_approx(_number(df, c), shares, 10 * (ranges + 1)).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]
    return df.agg(F.struct(*found).alias("cuts")).scalar()


def _interleave(cuts: Column, df: DataFrame, columns: Sequence[str], bits: int) -> Column:
    position = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        # One less, so that equally frequent values end at the powers of two.
        below = count_not_above(cuts[f"c{i}"], _number(df, name)) - 1
        below = F.greatest(F.coalesce(below, F.lit(0)), F.lit(0)).cast("long")
        spread = F.lit(0).cast("long")
        for bit in range(bits):
            one = F.shiftright(below, bit).bitwiseAND(F.lit(1))
            # The first column's bit is the highest of its level.
            spread = spread + F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i)
        position = position + spread
    return position


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values (texts: by their first bytes)."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        head = F.hex(F.substring(F.encode(value, "UTF-8"), 1, TEXT_BYTES))
        return F.conv(F.rpad(head, 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
    raise ValueError(f"cannot order rows by {name!r} of type {kind.simpleString()}")

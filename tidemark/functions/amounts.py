"""Expressions of the rental arithmetic: stays, totals, tax, transaction ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: value-added tax on a rental.
TAX_RATE = "0.125"
# Shape of a transaction id, TXN-yyyyMMdd-nnnnn.
TRANSACTION_PREFIX = "TXN"
TRANSACTION_DATE_FORMAT = "yyyyMMdd"


def money(value: Column | str) -> Column:
    """Exact two-digit money; sums of it do not depend on the order of rows."""
    col = F.col(value) if isinstance(value, str) else value
    return col.cast("decimal(18,2)")


def days_after(date: Column | str, days: Column | int) -> Column:
    col = F.col(date) if isinstance(date, str) else date
    return F.date_add(col, days)


def tax_on(total: Column) -> Column:
    """Tax rounded half up on decimals (rounding doubles would drift)."""
    return F.round(total.cast("decimal(18,2)") * F.lit(TAX_RATE).cast("decimal(4,3)"), 2).cast(
        "decimal(18,2)"
    )


def total_with_tax(total: Column) -> Column:
    return (total.cast("decimal(18,2)") + tax_on(total)).cast("decimal(18,2)")


def transaction_id(date: Column, number: Column) -> Column:
    """``TXN-<date>-<number>``; numbers shorter than five digits are zero padded."""
    text = number.cast("string")
    padded = F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)
    return F.concat_ws(
        "-", F.lit(TRANSACTION_PREFIX), F.date_format(date, TRANSACTION_DATE_FORMAT), padded
    )


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def iso_timestamp(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")


def random_guid() -> Column:
    return F.expr("uuid()")


def content_guid(*parts: Column) -> Column:
    """A guid-shaped digest of the content, for ids that must repeat on a re-run."""
    digest = F.md5(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")

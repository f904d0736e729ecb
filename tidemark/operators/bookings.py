"""Booking tables: submit requests, list what is pending, confirm a selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.amounts import content_guid, iso_date, iso_timestamp, random_guid
from tidemark.functions.salting import key_salt, spreading_salt
from tidemark.operators.quality import Rule, expectations

# Columns of a booking and of a confirmed booking.
BOOKING_COLUMNS = ("guid", "name", "email", "from_date", "to_date", "booking_time", "notes")
CONFIRMED_SCHEMA = (
    "guid string, name string, email string, from_date date, to_date date, "
    "booking_time timestamp, notes string, confirmation_date timestamp, is_confirmed boolean"
)

SUBMIT_RULES = [
    Rule("name given", "name is not null and name <> ''", "expect_or_drop"),
    Rule("email given", "email is not null and email <> ''", "expect_or_drop"),
    Rule("stay not negative", "to_date >= from_date", "expect_or_drop"),
]


def submit(
    requests: DataFrame,
    booking_time: Column | None = None,
    repeatable_guid: bool = False,
) -> tuple[DataFrame, Observation | str]:
    """Valid requests, stamped with guid and time, in the text form that lands as JSON.

    ``repeatable_guid`` derives the guid from the content, so that a re-run lands
    the same bookings again instead of new ones.
    """
    valid, counters = expectations(requests, SUBMIT_RULES)
    time = booking_time if booking_time is not None else F.current_timestamp()
    guid = (
        content_guid(*[F.col(c) for c in ("name", "email", "from_date", "to_date", "notes")])
        if repeatable_guid
        else random_guid()
    )
    landed = valid.select(
        guid.alias("guid"),
        "name",
        "email",
        iso_date(F.col("from_date")).alias("from_date"),
        iso_date(F.col("to_date")).alias("to_date"),
        iso_timestamp(time).alias("booking_time"),
        "notes",
    )
    return landed, counters


def typed(bookings: DataFrame) -> DataFrame:
    """Landed text bookings with date and timestamp columns."""
    return bookings.withColumns(
        {
            "from_date": F.to_date("from_date"),
            "to_date": F.to_date("to_date"),
            "booking_time": F.to_timestamp("booking_time"),
        }
    )


def pending(
    bookings: DataFrame, confirmed: DataFrame, key: str = "guid", null_aware: bool = False
) -> DataFrame:
    """Bookings without a confirmation.

    The default is a plain anti join; bookings without a key are all pending and
    are spread over the shuffle. ``null_aware`` has the meaning of SQL
    ``NOT IN``: a null among the confirmed keys leaves nothing, and a null key is
    pending only if nothing is confirmed. It is built from the anti join and two
    scalars instead of Spark's own null-aware join, which always broadcasts the
    confirmed side, whatever its size.
    """
    done = confirmed.select(F.col(key).alias("_done"))
    salted = done.withColumn("_done_salt", key_salt(F.col("_done")))
    row_hash = F.xxhash64(F.to_json(F.struct("*")))
    open_rows = (
        bookings.withColumn("_salt", spreading_salt(F.col(key), row_hash))
        .join(
            salted,
            (F.col(key) == F.col("_done")) & (F.col("_salt") == F.col("_done_salt")),
            "left_anti",
        )
        .drop("_salt")
    )
    if not null_aware:
        return open_rows
    facts = done.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_done").isNull()).alias("nulls"),
        )
    ).scalar()
    return (
        open_rows.withColumn("_confirmed", facts)
        .filter(
            (F.col("_confirmed.rows") == 0)
            | ((F.col("_confirmed.nulls") == 0) & F.col(key).isNotNull())
        )
        .drop("_confirmed")
    )


def confirm(
    bookings: DataFrame,
    selected: DataFrame,
    key: str = "guid",
    confirmation_time: Column | None = None,
) -> DataFrame:
    """The selected bookings with their confirmation, ready to append by column name."""
    time = confirmation_time if confirmation_time is not None else F.current_timestamp()
    chosen = selected.select(F.col(key).alias("_chosen"))
    return (
        bookings.join(chosen, F.col(key) == F.col("_chosen"), "left_semi")
        .withColumn("confirmation_date", time)
        .withColumn("is_confirmed", F.lit(True))
    )

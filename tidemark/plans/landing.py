"""Landing data for the rental pipeline, generated on the executors.

Every value is a function of the row's id, a salt and a seed, so a run can be
repeated exactly and any partition can be recomputed. The id frames decide the
size: a range, or the ids of a table that is already there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.amounts import days_after, tax_on, total_with_tax, transaction_id
from tidemark.functions.search import hash_bucket
from tidemark.operators.surrogate import surrogate_key
from tidemark.sinks.tables import write_files

# The domains of the landing columns.
LOYALTY_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
PAYMENT_METHODS = ["Credit Card", "MobilePay", "Bank Transfer"]
ACCOUNT_MANAGERS = ["Anders Holm", "Maria Lund", "Thomas Vestergaard"]
SELLER_MANAGERS = ["Rasmus Holm", "Camilla Vestergaard", "Jonas Mikkelsen"]
CONTACT_METHODS = ["Email", "Phone", "Slack"]
GENDERS = ["Male", "Female"]
REGIONS = ["Midtjylland", "Sjælland", "Nordjylland", "Syddanmark", "Hovedstaden"]
AMENITIES = [
    "WiFi",
    "Fireplace",
    "Kayaks",
    "BBQ Grill",
    "Smart TV",
    "Washer/Dryer",
    "Dock",
    "Bicycles",
]
DISCOUNT_CODES = ["SUMMER25", "WELCOME10", "", "", ""]
BOOKING_CHANNELS = ["Website", "Mobile App", "Phone"]
COUNTRY = "Denmark"
CURRENCY = "DKK"
# Rows per entity in a standard landing run.
STANDARD_SIZES = {"customer": 1000, "lakehouse": 200, "seller": 200, "lakehouse_rentals": 4999}

# Pools of our own for names and texts; house names are every stem with every noun.
HOUSE_STEMS = ["Birk", "Elm", "Fyrre", "Hav", "Klit", "Lyng", "Mose", "Sand", "Strand", "Vig"]
HOUSE_NOUNS = ["bakken Hytte", "dal Hus", "engen Lodge", "gaard", "holm Hytte", "toppen"]
FIRST_NAMES = ["Ida", "Karl", "Emma", "Noah", "Freja", "Oscar", "Alma", "Lucas", "Ella", "Aksel"]
LAST_NAMES = ["Berg", "Dahl", "Friis", "Krogh", "Lind", "Munk", "Rask", "Skov", "Toft", "Winther"]
CITIES = ["Aalborg", "Aarhus", "Esbjerg", "Kolding", "Odense", "Randers", "Roskilde", "Vejle"]
STREETS = ["Bakkevej", "Engvej", "Fjordgade", "Havnevej", "Lindevej", "Skolegade", "Strandvej"]
REVIEW_TITLES = ["A quiet week", "Close to the water", "Not for us", "Would come again"]
REVIEW_TEXTS = [
    "The house was clean and the view as promised.",
    "Good beds, a small kitchen and a long way to the shop.",
    "The heating failed twice but help came quickly.",
    "Children loved the garden and the boat.",
]

# Marketing weights: a row is active in two of three cases.
ACTIVE_FLAGS = [True, True, False]


class _Row:
    """Reproducible draws for one id column."""

    def __init__(self, key: str, seed: str) -> None:
        self.key, self.seed = F.col(key), seed

    def bucket(self, salt: str, size: Column | int) -> Column:
        return hash_bucket([self.key], size, f"{self.seed}:{salt}")

    def pick(self, salt: str, pool: list) -> Column:
        options = F.array(*[F.lit(v) for v in pool])
        return F.element_at(options, (self.bucket(salt, len(pool)) + 1).cast("int"))

    def flag(self, salt: str) -> Column:
        return self.bucket(salt, 2) == 1

    def whole(self, salt: str, low: int, high: int) -> Column:
        return F.lit(low) + self.bucket(salt, high - low + 1)

    def number(self, salt: str, low: float, high: float, digits: int = 2) -> Column:
        """A decimal fraction with the given digits, both ends included."""
        unit = 10**digits
        steps = round((high - low) * unit) + 1
        return ((F.lit(round(low * unit)) + self.bucket(salt, steps)) / unit).cast("double")

    def date(self, salt: str, start: Column, end: Column) -> Column:
        span = F.greatest(F.datediff(end, start), F.lit(0)) + 1
        return F.date_add(start, self.bucket(salt, span).cast("int"))

    def person(self, salt: str) -> Column:
        first, last = self.pick(f"{salt}:first", FIRST_NAMES), self.pick(f"{salt}:last", LAST_NAMES)
        return F.concat_ws(" ", first, last)

    def email(self, salt: str) -> Column:
        local = F.lower(F.regexp_replace(self.person(salt), " ", "."))
        return F.concat(local, F.lit("."), self.key.cast("string"), F.lit("@example.com"))

    def digits(self, salt: str, count: int) -> Column:
        return F.lpad(self.bucket(salt, 10**count).cast("string"), count, "0")

    def street(self, salt: str) -> Column:
        return F.concat_ws(" ", self.pick(salt, STREETS), self.whole(f"{salt}:no", 1, 199))


def _id_frame(ids: DataFrame, name: str) -> DataFrame:
    return ids.select(F.col(ids.columns[0]).cast("long").alias(name))


def _months_before(today: Column, months: int) -> Column:
    return F.add_months(today, -months)


def customers(ids: DataFrame, today: dt.date, seed: str = "42") -> DataFrame:
    """One customer per id (first column of ``ids``), 18 columns."""
    row, now = _Row("customer_id", f"{seed}:customer"), F.lit(today)
    registered = row.date("registered", _months_before(now, 60), _months_before(now, 1))
    return (
        _id_frame(ids, "customer_id")
        .withColumn("registration_date", registered)
        .select(
            "customer_id",
            row.person("name").alias("name"),
            row.email("name").alias("email"),
            F.concat(F.lit("+45 "), row.digits("phone", 8)).alias("phone_number"),
            row.date("birth", _months_before(now, 75 * 12), _months_before(now, 18 * 12)).alias(
                "birth_date"
            ),
            row.pick("gender", GENDERS).alias("gender"),
            row.street("street").alias("address"),
            row.pick("city", CITIES).alias("city"),
            row.digits("postal", 4).alias("postal_code"),
            F.lit(COUNTRY).alias("country"),
            "registration_date",
            row.pick("tier", LOYALTY_TIERS).alias("loyalty_tier"),
            row.pick("payment", PAYMENT_METHODS).alias("preferred_payment_method"),
            row.pick("manager", ACCOUNT_MANAGERS).alias("account_manager"),
            row.flag("newsletter").alias("is_subscribed_to_newsletter"),
            row.date("last", F.col("registration_date"), now).alias("last_purchase_date"),
            row.number("spend", 500, 50000).alias("total_spend"),
            row.whole("purchases", 1, 100).alias("number_of_purchases"),
        )
    )


def lakehouses(ids: DataFrame, today: dt.date, seed: str = "42") -> DataFrame:
    """One house per id, 21 columns; three to six different amenities each."""
    row, now = _Row("lakehouse_id", f"{seed}:lakehouse"), F.lit(today)
    shuffled = F.array_sort(
        F.array(
            *[
                F.struct(row.bucket(f"amenity:{a}", 2**31).alias("h"), F.lit(a).alias("name"))
                for a in AMENITIES
            ]
        )
    )
    chosen = F.slice(shuffled, F.lit(1), row.whole("amenities", 3, 6).cast("int"))
    return (
        _id_frame(ids, "lakehouse_id")
        .withColumn("bedrooms", row.whole("bedrooms", 1, 6))
        .select(
            "lakehouse_id",
            F.concat(row.pick("stem", HOUSE_STEMS), row.pick("noun", HOUSE_NOUNS)).alias("name"),
            row.pick("location", CITIES).alias("location"),
            row.pick("region", REGIONS).alias("region"),
            row.street("street").alias("address"),
            row.digits("postal", 4).alias("postal_code"),
            F.lit(COUNTRY).alias("country"),
            "bedrooms",
            row.whole("bathrooms", 1, 3).alias("bathrooms"),
            (F.col("bedrooms") * row.whole("guests", 2, 3)).alias("max_guests"),
            row.number("rate", 850, 2500).alias("nightly_rate"),
            row.flag("pets").alias("is_pet_friendly"),
            row.flag("sauna").alias("has_sauna"),
            row.flag("tub").alias("has_hot_tub"),
            row.flag("view").alias("has_lake_view"),
            F.transform(chosen, lambda a: a["name"]).alias("amenities"),
            row.person("owner").alias("owner_name"),
            row.email("owner").alias("owner_email"),
            row.date("listed", _months_before(now, 36), now).alias("listing_date"),
            row.number("rating", 3.5, 5.0, 1).alias("rating"),
            row.pick("active", ACTIVE_FLAGS).alias("is_active"),
        )
    )


def numbered(parents: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """Parents with a dense position ``_at``, and their number, for draws by position."""
    count = parents.agg(F.count(F.lit(1))).scalar()
    return surrogate_key(parents, key, "_at"), count


def sellers(ids: DataFrame, houses: DataFrame, today: dt.date, seed: str = "42") -> DataFrame:
    """One seller per id, 16 columns, each with one to three house names (repeats possible)."""
    row, now = _Row("seller_id", f"{seed}:seller"), F.lit(today)
    places, n_houses = numbered(houses.select("lakehouse_id", "name"), "lakehouse_id")
    picks = (
        _id_frame(ids, "seller_id")
        .withColumn("pick", F.explode(F.sequence(F.lit(1), row.whole("houses", 1, 3).cast("int"))))
        .withColumn(
            "_at",
            hash_bucket([F.col("seller_id"), F.col("pick")], n_houses, f"{seed}:seller:house"),
        )
    )
    # Three names per seller at most, so the collected groups stay small.
    assigned = (
        picks.join(places.select("_at", "name"), "_at")
        .groupBy("seller_id")
        .agg(F.sort_array(F.collect_list(F.struct("pick", "name"))).alias("picked"))
        .select("seller_id", F.transform("picked", lambda p: p["name"]).alias("assigned_lakehouses"))
    )
    return (
        assigned.withColumn(
            "hire_date", row.date("hired", _months_before(now, 60), _months_before(now, 6))
        )
        .select(
            "seller_id",
            row.person("name").alias("name"),
            row.email("name").alias("email"),
            F.concat(F.lit("+45 "), row.digits("phone", 8)).alias("phone_number"),
            "hire_date",
            row.pick("region", REGIONS).alias("region"),
            "assigned_lakehouses",
            row.number("sales", 100000, 1500000).alias("total_sales"),
            row.whole("bookings", 50, 500).alias("number_of_bookings"),
            row.number("commission", 0.05, 0.15).alias("commission_rate"),
            row.number("target", 50000, 200000).alias("monthly_target"),
            row.pick("active", ACTIVE_FLAGS).alias("is_active"),
            row.date("booked", F.col("hire_date"), now).alias("last_booking_date"),
            row.number("performance", 3.0, 5.0, 1).alias("performance_rating"),
            row.pick("manager", SELLER_MANAGERS).alias("manager_name"),
            row.pick("contact", CONTACT_METHODS).alias("preferred_contact_method"),
        )
    )


def rentals(
    ids: DataFrame,
    customer: DataFrame,
    seller: DataFrame,
    lakehouse: DataFrame,
    today: dt.date,
    seed: str = "42",
) -> DataFrame:
    """One rental per id, 26 columns; parents drawn uniformly and joined by position."""
    row, now = _Row("rental_id", f"{seed}:rental"), F.lit(today)
    half_year = _months_before(now, 6)
    buyers, n_buyers = numbered(customer.select("customer_id", "name", "email"), "customer_id")
    agents, n_agents = numbered(seller.select("seller_id", "name", "email"), "seller_id")
    houses, n_houses = numbered(lakehouse.select("lakehouse_id", "name"), "lakehouse_id")
    drawn = (
        _id_frame(ids, "rental_id")
        .withColumn("_buyer", row.bucket("customer", n_buyers))
        .withColumn("_agent", row.bucket("seller", n_agents))
        .withColumn("_house", row.bucket("lakehouse", n_houses))
        .withColumn("check_in_date", row.date("check_in", half_year, now))
        .withColumn("_nights", row.whole("nights", 2, 7))
        .withColumn("nightly_rate", row.whole("rate", 900, 1800))
        .withColumn("total_cost", F.col("nightly_rate") * F.col("_nights"))
        .withColumn("order_date", row.date("order", half_year, F.col("check_in_date")))
    )
    joined = (
        drawn.join(
            buyers.select(
                F.col("_at").alias("_buyer"),
                "customer_id",
                F.col("name").alias("customer_name"),
                "email",
            ),
            "_buyer",
        )
        .join(
            agents.select(
                F.col("_at").alias("_agent"),
                "seller_id",
                F.col("name").alias("seller_name"),
                F.col("email").alias("seller_email"),
            ),
            "_agent",
        )
        .join(
            houses.select(
                F.col("_at").alias("_house"), "lakehouse_id", F.col("name").alias("lakehouse_name")
            ),
            "_house",
        )
    )
    total = F.col("total_cost")
    return joined.select(
        "rental_id",
        "seller_id",
        "customer_id",
        "lakehouse_id",
        "customer_name",
        "email",
        "check_in_date",
        days_after("check_in_date", F.col("_nights").cast("int")).alias("check_out_date"),
        "lakehouse_name",
        row.pick("location", CITIES).alias("location"),
        row.whole("bedrooms", 1, 5).alias("bedrooms"),
        "nightly_rate",
        "total_cost",
        row.flag("pets").alias("is_pet_friendly"),
        row.number("rating", 3.0, 5.0, 1).alias("rating"),
        "order_date",
        "seller_name",
        "seller_email",
        row.pick("manager", ACCOUNT_MANAGERS).alias("account_manager"),
        row.pick("payment", PAYMENT_METHODS).alias("payment_method"),
        transaction_id(F.col("order_date"), row.whole("transaction", 10000, 99999)).alias(
            "transaction_id"
        ),
        row.pick("discount", DISCOUNT_CODES).alias("discount_code"),
        row.pick("channel", BOOKING_CHANNELS).alias("booking_channel"),
        F.lit(CURRENCY).alias("currency"),
        tax_on(total).cast("double").alias("tax_amount"),
        total_with_tax(total).cast("double").alias("total_cost_with_tax"),
    )


def reviews(rental: DataFrame, seed: str = "42") -> DataFrame:
    """One review per rental, one to seven days after check-out."""
    row = _Row("rental_id", f"{seed}:review")
    return rental.select(
        "rental_id",
        days_after("check_out_date", row.whole("days", 1, 7).cast("int")).alias("review_date"),
        row.whole("stars", 1, 5).alias("rating"),
        row.pick("text", REVIEW_TEXTS).alias("review_text"),
        row.pick("title", REVIEW_TITLES).alias("review_title"),
        row.whole("votes", 0, 100).alias("helpful_votes"),
    )


def land(
    spark: SparkSession,
    root: str,
    today: dt.date,
    sizes: dict[str, int] | None = None,
    seed: str = "42",
    file_format: str = "parquet",
) -> dict[str, str]:
    """Write a snapshot of all five entities below ``root``; returns their folders.

    Parents are read back from their files, so that children do not recompute them.
    """
    sizes = {**STANDARD_SIZES, **(sizes or {})}

    def ids(entity: str) -> DataFrame:
        return spark.range(1, sizes[entity] + 1)

    def store(df: DataFrame, entity: str) -> DataFrame:
        write_files(df, f"{root}/{entity}", file_format)
        return spark.read.format(file_format).load(f"{root}/{entity}")

    customer = store(customers(ids("customer"), today, seed), "customer")
    lakehouse = store(lakehouses(ids("lakehouse"), today, seed), "lakehouse")
    seller = store(sellers(ids("seller"), lakehouse, today, seed), "seller")
    rental = store(
        rentals(ids("lakehouse_rentals"), customer, seller, lakehouse, today, seed),
        "lakehouse_rentals",
    )
    store(reviews(rental, seed), "reviews")
    return {
        e: f"{root}/{e}"
        for e in ("customer", "lakehouse", "seller", "lakehouse_rentals", "reviews")
    }

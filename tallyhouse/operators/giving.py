"""The person-level giving extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import latest_per_key

# Dictionary types of the extract's decoded columns, the home
# location type, the mobile number type and the left-out transaction source.
CURRENCY_TYPE, CARD_TYPE, REFUND_TYPE = 10, 11, 37
HOME_LOCATION, MOBILE_NUMBER, EXCLUDED_SOURCE = 19, 12, 2521


def home_locations(group_locations: DataFrame, locations: DataFrame,
                   location_type: int = HOME_LOCATION) -> DataFrame:
    """The newest home location of each family."""
    homes = group_locations.where(F.col("location_type") == location_type)
    newest = latest_per_key(homes.select("family_id", "id", "location_id"), ["family_id"], ["id"])
    return newest.drop("id").join(locations, "location_id")


def latest_phones(numbers: DataFrame, number_type: int = MOBILE_NUMBER) -> DataFrame:
    """The newest mobile number of each person."""
    mobile = numbers.where(F.col("number_type") == number_type)
    return latest_per_key(mobile.select("person_id", "created_at", "id", "phone_number"),
                          ["person_id"], ["created_at", "id"]).select("person_id", "phone_number")


def decoded(df: DataFrame, values: DataFrame, column: str, defined_type: int,
            out: str) -> DataFrame:
    """Decode a dictionary id, but only within one dictionary type."""
    side = values.where(F.col("defined_type_id") == defined_type).select(
        F.col("defined_value_id").alias(column), F.col("value").alias(out))
    return df.join(side, column, "left")


def giving_extract(transactions: DataFrame, details: DataFrame, accounts: DataFrame,
                   payments: DataFrame, batches: DataFrame, refunds: DataFrame,
                   values: DataFrame, aliases: DataFrame, people: DataFrame,
                   phones: DataFrame, homes: DataFrame, since, until,
                   funds: Sequence[int] | None = None,
                   excluded_source: int = EXCLUDED_SOURCE) -> DataFrame:
    """Transactions of a period with fund, person, address, phone and payment data.

    Period, source and fund filters run before any join; the transactions are cut
    to the period first and stay the streamed side of every join. `homes` and
    `phones` hold one row per family and person, so no join fans out except to the
    details themselves.
    """
    source = F.col("source_type_value_id")
    tx = transactions.where((F.col("transaction_at") >= F.lit(since).cast("timestamp"))
                            & (F.col("transaction_at") < F.lit(until).cast("timestamp"))
                            & (source.isNull() | (source != excluded_source)))
    lines = details if funds is None else details.where(F.col("account_id").isin(list(funds)))
    out = (tx.join(lines, "transaction_id")
           .join(accounts.select("account_id", "fund_name"), "account_id")
           .join(payments, "payment_id")
           .join(batches.select("batch_id", "batch_name"), "batch_id", "left")
           .join(refunds, "transaction_id", "left"))
    out = decoded(out, values, "currency_value_id", CURRENCY_TYPE, "currency_type")
    out = decoded(out, values, "card_value_id", CARD_TYPE, "credit_card_type")
    out = decoded(out, values, "refund_value_id", REFUND_TYPE, "refund_reason")
    out = (out.join(aliases.select(F.col("person_alias_id").alias("authorized_alias_id"),
                                   "person_id"), "authorized_alias_id")
           .join(people.select("person_id", "family_id", "first_name", "last_name", "email"),
                 "person_id")
           .join(phones, "person_id", "left").join(homes, "family_id", "left"))
    return out.select(
        "fund_name", "transaction_id", "person_id", "family_id",
        F.concat("last_name", F.lit(" Family")).alias("family_name"), "first_name",
        "last_name", "email", "phone_number", "city", "currency_type", "credit_card_type",
        "amount", "transaction_at", "batch_name", "refund_reason").distinct()

"""Declared schemas of the five raw sources (inference stays an option)."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


CUSTOMERS = _s(
    ("customer_id", StringType()),
    ("name", StringType()),
    ("country", StringType()),
    ("customer_type", StringType()),
    ("risk_category", StringType()),
)
ACCOUNTS = _s(("account_id", StringType()), ("customer_id", StringType()), ("status", StringType()))
CREDIT_HISTORY = _s(
    ("customer_id", StringType()),
    ("credit_score", IntegerType()),
    ("open_loans", IntegerType()),
    ("last_default_date", DateType()),
)
METADATA = _s(("device", StringType()), ("ip_address", StringType()), ("channel", StringType()))
TRANSACTIONS = _s(
    ("transaction_id", StringType()),
    ("account_id", StringType()),
    ("amount", DoubleType()),
    ("currency", StringType()),
    ("transaction_type", StringType()),
    ("merchant", StringType()),
    ("location", StringType()),
    ("timestamp", StringType()),
    ("metadata", METADATA),
)

# Complaints are ingested as they come; no column of them is ever read.
SOURCES = {
    "customers": ("csv", CUSTOMERS),
    "accounts": ("csv", ACCOUNTS),
    "complaints": ("csv", None),
    "credit_history": ("csv", CREDIT_HISTORY),
    "transactions": ("json", TRANSACTIONS),
}

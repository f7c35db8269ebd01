"""Declared schemas: landing sources, silver contracts, gold and warehouse.

Sources are always read with an explicit ``StructType``: schema inference
costs an extra pass over the files and drifts between batches.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, DT, L, I, B = (T.StringType(), T.DoubleType(), T.TimestampType(),
                         T.DateType(), T.LongType(), T.IntegerType(), T.BooleanType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Column names and types of the five sources, the silver
# contracts, the gold view and its external projection.  They must equal the
# files and tables of the pipeline being re-implemented.
# ---------------------------------------------------------------------------

CUSTOMER_ONBOARDING = _struct(
    ("customer_id", S), ("full_name", S), ("date_of_birth", DT), ("ssn", S),
    ("email", S), ("phone", S), ("address", S), ("country", S),
    ("onboarding_date", DT), ("customer_segment", S), ("pep_flag", S),
    ("source_system", S), ("record_date", DT))

TRANSACTION_FEED = _struct(
    ("transaction_id", S), ("customer_id", S), ("txn_date", TS), ("amount", D),
    ("currency", S), ("txn_type", S), ("channel", S), ("beneficiary_country", S),
    ("cross_border_flag", S), ("status", S), ("source_system", S))

KYC_DOCUMENTS = _struct(
    ("doc_id", S), ("customer_id", S), ("doc_type", S), ("doc_status", S),
    ("verification_date", DT), ("expiry_date", DT), ("verified_by", S),
    ("risk_notes", S), ("source_system", S), ("batch_timestamp", TS))

WATCHLIST_SANCTIONS = _struct(
    ("watchlist_id", S), ("entity_name", S), ("alias", S), ("list_type", S),
    ("country", S), ("designation", S), ("listed_date", DT),
    ("source_system", S), ("record_date", DT))

ACCOUNT_ACTIVITY = _struct(
    ("account_id", S), ("customer_id", S), ("account_type", S),
    ("account_status", S), ("balance", D), ("balance_tier", S),
    ("last_activity_date", S), ("days_since_activity", L), ("dormant_flag", S),
    ("branch_code", S), ("source_system", S), ("batch_hour", S))

# Columns that a source delivers as text and silver holds in their own type.
SILVER_TYPES: dict[str, dict[str, str]] = {
    "account_activity": {"last_activity_date": "date", "batch_hour": "timestamp"},
}

SOURCES: dict[str, T.StructType] = {
    "customer_onboarding": CUSTOMER_ONBOARDING,
    "transaction_feed": TRANSACTION_FEED,
    "kyc_documents": KYC_DOCUMENTS,
    "watchlist_sanctions": WATCHLIST_SANCTIONS,
    "account_activity": ACCOUNT_ACTIVITY,
}

# Landing file format per source (csv with header, newline JSON, one JSON
# array per file, Parquet files arriving as a stream).
SOURCE_FORMATS: dict[str, str] = {
    "customer_onboarding": "csv",
    "transaction_feed": "ndjson",
    "kyc_documents": "json_array",
    "watchlist_sanctions": "csv",
    "account_activity": "parquet_stream",
}

# Required silver columns per table (checked by name, and by type if given).
SILVER_CONTRACTS: dict[str, tuple[str, ...]] = {
    "customer_onboarding": ("customer_id", "full_name", "ssn", "date_of_birth",
                            "email", "phone", "country", "pep_flag",
                            "effective_from", "effective_to", "is_current"),
    "transaction_feed": ("transaction_id", "customer_id", "amount",
                         "cross_border_flag", "txn_type", "status"),
    "kyc_documents": ("doc_id", "customer_id", "doc_status", "doc_type",
                      "expiry_date"),
    "watchlist_sanctions": ("watchlist_id", "entity_name", "list_type",
                            "designation"),
    "account_activity": ("account_id", "customer_id", "dormant_flag",
                         "days_since_activity", "balance_tier"),
}

# Unified customer view, in published order (gold_timestamp is appended).
GOLD_COLUMNS: tuple[str, ...] = (
    "customer_id", "full_name", "country", "customer_segment", "pep_flag",
    "doc_status", "expiry_date",
    "txn_count", "txn_total_amt", "cross_border_count", "velocity_risk",
    "dormant_flag", "days_since_activity", "balance_tier",
    "risk_score", "kyc_risk_level", "aml_flag", "dormancy_alert",
    "high_risk_profile",
    "effective_from", "effective_to", "is_current",
)

# External (warehouse-facing) projection of the gold view with declared types.
# Flags stay boolean end to end; dates kept as text as the external DDL does.
EXTERNAL_CUSTOMER_360 = _struct(
    ("customer_id", S), ("full_name", S), ("country", S), ("customer_segment", S),
    ("pep_flag", S), ("doc_status", S), ("expiry_date", S), ("txn_count", L),
    ("txn_total_amt", D), ("cross_border_count", L), ("velocity_risk", S),
    ("dormant_flag", S), ("days_since_activity", L), ("balance_tier", S),
    ("risk_score", L), ("kyc_risk_level", S), ("aml_flag", B),
    ("dormancy_alert", B), ("high_risk_profile", B))

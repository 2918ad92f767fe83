"""Logical table schemas and the required-column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


CUSTOMER_PROFILES = _struct(
    ("customer_id", T.LongType()),
    ("name", T.StringType()),
    ("gender", T.StringType()),
    ("age", T.IntegerType()),
    ("country", T.StringType()),
    ("customer_tier", T.StringType()),
    ("signup_date", T.DateType()),
    ("months_since_signup", T.IntegerType()),
    ("churned", T.BooleanType()),
    ("clv", MONEY),
    ("next_purchase_prob", T.DoubleType()),
)

PURCHASE_HISTORY = _struct(
    ("order_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("order_date", T.DateType()),
    ("order_amount", MONEY),
)

PURCHASE_LINES = _struct(
    *[(f.name, f.dataType) for f in PURCHASE_HISTORY],
    ("product_category", T.StringType()),
    ("discount_used", T.BooleanType()),
    ("discount_value", MONEY),
)

ENGAGEMENT_BEHAVIOR = _struct(
    ("customer_id", T.LongType()),
    ("weekly_visits", T.LongType()),
    ("session_time_minutes", T.DoubleType()),
    ("page_views", T.LongType()),
    ("app_opens", T.LongType()),
)

MARKETING_PROMOTIONS = _struct(
    ("customer_id", T.LongType()),
    ("campaign_name", T.StringType()),
    ("discount", T.DoubleType()),
    ("variant", T.IntegerType()),
    ("responded", T.IntegerType()),
    ("additional_revenue", MONEY),
)

CHURN_FEATURES = _struct(
    ("customer_id", T.LongType()),
    ("total_purchase", T.DoubleType()),
    ("avg_purchase_value", T.DoubleType()),
    ("engagement_score", T.DoubleType()),
    ("last_purchase_days", T.DoubleType()),
    ("marketing_interactions", T.DoubleType()),
    ("churn", T.IntegerType()),
)


#: What the adapter reads of each table of a data folder.
SOURCE_COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
    "nation": ("n_nationkey", "n_name"),
    "orders": ("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
    "lineitem": ("l_orderkey", "l_partkey", "l_extendedprice", "l_discount"),
    "part": ("p_partkey", "p_type"),
    "events": ("user_id", "ts", "event_type", "value"),
}


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """The required columns that ``df`` lacks, in order."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise a ValueError naming what is missing."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df

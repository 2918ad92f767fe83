"""Source, sink and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.functions import calendar, numeric, text
from clientele.plans.reference_sql import d, r, with_tables
from clientele.plans.registry import query
from clientele.sources import readers, schemas, sinks
from clientele.sources.scratch import scratch_path

_ALL_ORDERS = with_tables(
    "purchases",
    f"""SELECT order_id, customer_id, order_date, {d('order_amount')} AS order_amount
        FROM purchases""",
)


def _plain(df):
    return df.withColumn("order_amount", F.col("order_amount").cast("double"))


@query("S1_load_delimited", _ALL_ORDERS)
def _(t):
    path = scratch_path(t.spark, "purchases")
    sinks.write_report(t.purchases, path)
    return _plain(readers.read_delimited(t.spark, path, schemas.PURCHASE_HISTORY))


@query("S9_report_as_parquet", _ALL_ORDERS)
def _(t):
    path = scratch_path(t.spark, "purchases")
    sinks.write_report(t.purchases, path, "parquet")
    return _plain(readers.read_columnar(t.spark, path, schemas.PURCHASE_HISTORY))


def _named(t):
    return {
        "customer_profiles": t.demographics,
        "purchase_history": t.purchases,
        "purchase_lines": t.lines,
        "engagement_behavior": t.engagement,
        "marketing_promotions": t.promotions,
    }


def _required_sql() -> str:
    needed = ", ".join(
        f"('{table}', '{column}')" for table, names in schemas.SOURCE_COLUMNS.items() for column in names
    )
    return f"""SELECT n.table_name, n.column_name, count(c.column_name) > 0 AS present
               FROM (VALUES {needed}) n(table_name, column_name)
               LEFT JOIN duckdb_columns() c ON c.table_name = n.table_name AND c.column_name = n.column_name
               GROUP BY ALL"""


@query("S4_required_columns", _required_sql())
def _(t):
    """The columns that the adapter reads, and whether the folder's tables have them."""
    rows = []
    for name, required in schemas.SOURCE_COLUMNS.items():
        missing = schemas.missing_columns(t.raw(name), required)
        rows += [(name, column, column not in missing) for column in required]
    return t.spark.createDataFrame(rows, "table_name string, column_name string, present boolean")


@query(
    "S2_registered_views",
    with_tables(
        "customers purchases lines engagement promotions",
        """SELECT 'customer_profiles' AS table_name, count(*) AS row_count FROM customers
           UNION ALL SELECT 'purchase_history', count(*) FROM purchases
           UNION ALL SELECT 'purchase_lines', count(*) FROM lines
           UNION ALL SELECT 'engagement_behavior', count(*) FROM engagement
           UNION ALL SELECT 'marketing_promotions', count(*) FROM promotions""",
    ),
)
def _(t):
    tables = _named(t)
    readers.register_views(tables)
    return readers.row_counts({name: t.spark.table(name) for name in tables})


# The columns of the logical tables and their types.
_LISTED = {
    "customer_profiles": (
        "customers",
        "customer_id bigint, name string, gender string, age int, country string, customer_tier string, "
        "signup_date date, months_since_signup int",
    ),
    "purchase_history": (
        "purchases",
        "order_id bigint, customer_id bigint, order_date date, order_amount decimal(18_2)",
    ),
    "purchase_lines": (
        "lines",
        "order_id bigint, order_amount decimal(18_2), discount_used boolean, discount_value decimal(18_2), "
        "product_category string, customer_id bigint, order_date date",
    ),
    "engagement_behavior": (
        "engagement",
        "customer_id bigint, weekly_visits bigint, session_time_minutes double, page_views bigint, app_opens bigint",
    ),
    "marketing_promotions": (
        "promotions",
        "customer_id bigint, campaign_name string, discount double, variant int, responded int, "
        "additional_revenue decimal(18_2)",
    ),
}


def _listing_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {i}::INTEGER AS ordinal, '{column}' AS column_name, "
        f"replace('{kind}', '_', ',') AS column_type, count(*) AS row_count FROM {table}"
        for name, (table, columns) in _LISTED.items()
        for i, (column, kind) in enumerate(c.split() for c in columns.split(", "))
    )


@query(
    "S3_schema_listing",
    with_tables("customers purchases lines engagement promotions", _listing_sql()),
)
def _(t):
    return readers.schema_listing(_named(t))


@query(
    "S6_lenient_dates",
    """WITH texts AS (SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 7 = 0 THEN 'unknown'
       WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw
       FROM orders)
       SELECT order_id, TRY_CAST(raw AS DATE) AS order_date FROM texts""",
)
def _(t):
    raw = (
        F.when(F.col("order_id") % 7 == 0, "unknown")
        .when(F.col("order_id") % 11 == 0, F.lit(None))
        .otherwise(F.date_format("order_date", "yyyy-MM-dd"))
    )
    return t.purchases.select("order_id", readers.lenient_date(raw).alias("order_date"))


def _orders_query(name: str, sql: str, columns):
    """A projection over all purchases, checked against the same in SQL.

    ``columns`` is a function, as expressions can only be built in a session.
    """

    @query(name, with_tables("purchases", f"SELECT order_id, {sql} FROM purchases"))
    def _(t):
        return t.purchases.select("order_id", *[c.alias(n) for n, c in columns().items()])



def _amount():
    return F.col("order_amount").cast("double")


def _cutoff():
    return F.lit("2001-09-01").cast("date")


def _maybe():
    return F.nullif(F.col("customer_id") % 3, F.lit(0))


_orders_query(
    "F1_month_start",
    "CAST(date_trunc('month', order_date) AS DATE) AS month",
    lambda: dict(
        month=calendar.month_of("order_date"),
    ),
)
_orders_query(
    "F2_month_difference",
    "CAST(2001 * 12 + 9 - year(order_date) * 12 - month(order_date) AS INTEGER) AS months",
    lambda: dict(
        months=calendar.months_between_starts("order_date", _cutoff()),
    ),
)
_orders_query(
    "F3_day_arithmetic",
    """CAST(DATE '2001-09-01' - order_date AS INTEGER) AS days, order_date - 30 AS before,
       order_date + 90 AS after""",
    lambda: dict(
        days=F.datediff(_cutoff(), "order_date"),
        before=F.date_sub("order_date", 30),
        after=F.date_add("order_date", 90),
    ),
)
_orders_query(
    "F4_week_closing_monday",
    "CAST(order_date + CAST((8 - isodow(order_date)) % 7 AS INTEGER) AS DATE) AS week_end",
    lambda: dict(
        week_end=calendar.week_closing_monday("order_date"),
    ),
)
_orders_query(
    "F5_week_of_month",
    "CAST((day(order_date) - 1) // 7 + 1 AS INTEGER) AS week_of_month",
    lambda: dict(
        week_of_month=calendar.week_of_month("order_date"),
    ),
)
_orders_query(
    "F6_year_membership",
    """CAST(year(order_date) AS INTEGER) AS year, year(order_date) IN (1996, 1998) AS listed""",
    lambda: dict(
        year=F.year("order_date"),
        listed=F.year("order_date").isin(1996, 1998),
    ),
)
_orders_query(
    "F7_future_dates",
    """CAST(order_date + 21 AS DATE) AS three_weeks_on,
       CAST(date_trunc('month', order_date) + INTERVAL 3 MONTH AS DATE) AS three_months_on""",
    lambda: dict(
        three_weeks_on=F.date_add("order_date", 21),
        three_months_on=F.add_months(calendar.month_of("order_date"), 3),
    ),
)
_orders_query(
    "F8_tenure",
    """CAST(floor((DATE '2001-09-01' - order_date) / 30.0) AS INTEGER) AS months,
       CAST(DATE '2001-09-01' - order_date AS INTEGER) AS days""",
    lambda: dict(
        months=calendar.tenure_months("order_date", _cutoff()),
        days=F.datediff(_cutoff(), "order_date"),
    ),
)
_orders_query(
    "F9_rounding",
    f"{r('order_amount', 0)} AS r0, {r('order_amount', 1)} AS r1, {r(d('order_amount') + ' / 7', 4)} AS r4",
    lambda: dict(
        r0=numeric.rounded("order_amount", 0),
        r1=numeric.rounded("order_amount", 1),
        r4=numeric.rounded(_amount() / 7, 4),
    ),
)
_orders_query(
    "F10_elementary_functions",
    f"""{r(f"exp(-{d('order_amount')} / 100000)", 6)} AS e, {r(f"sqrt({d('order_amount')})", 4)} AS s,
        abs({d('order_amount')} - 250000) AS a, CAST(ceil({d('order_amount')} / 100) AS BIGINT) AS c,
        least(greatest({d('order_amount')}, 5000), 400000) AS bounded""",
    lambda: dict(
        e=numeric.rounded(F.exp(-_amount() / 100000), 6),
        s=numeric.rounded(F.sqrt(_amount()), 4),
        a=F.abs(_amount() - 250000),
        c=F.ceil(_amount() / 100),
        bounded=numeric.clipped(_amount(), 5000.0, 400000.0),
    ),
)
_orders_query(
    "F11_null_handling",
    """nullif(customer_id % 3, 0) AS maybe, coalesce(nullif(customer_id % 3, 0), -1) AS filled,
       order_id / CAST(nullif(customer_id % 3, 0) AS DOUBLE) AS guarded""",
    lambda: dict(
        maybe=_maybe(),
        filled=F.coalesce(_maybe(), F.lit(-1)),
        guarded=numeric.ratio("order_id", F.col("customer_id") % 3),
    ),
)
_orders_query(
    "F12_case_ladder",
    """CASE WHEN order_amount >= 400000 THEN 'large' WHEN order_amount >= 100000 THEN 'medium'
       ELSE 'small' END AS size""",
    lambda: dict(
        size=numeric.first_match(
        [(F.col("order_amount") >= 400000, "large"), (F.col("order_amount") >= 100000, "medium")],
        "small",
    ),
    ),
)
_orders_query(
    "F13_score_cell",
    """CAST(order_id % 5 + 1 AS VARCHAR) || CAST(customer_id % 5 + 1 AS VARCHAR) || '3' AS cell""",
    lambda: dict(
        cell=text.score_cell(F.col("order_id") % 5 + 1, F.col("customer_id") % 5 + 1, F.lit(3)),
    ),
)
_orders_query(
    "F14_money_and_percent_text",
    """'$' || format('{:,.2f}', CAST(order_amount AS DOUBLE)) AS money,
       format('{:,.1f}', CAST(order_id % 1000 AS DOUBLE)) || '%' AS pct""",
    lambda: dict(
        money=text.dollars(_amount(), 2),
        pct=text.percentage((F.col("order_id") % 1000).cast("double"), 1),
    ),
)
_orders_query(
    "F15_label_lookup",
    """CASE order_id % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'east' WHEN 2 THEN 'south' END AS side""",
    lambda: dict(
        side=text.lookup((F.col("order_id") % 4).cast("int"), {0: "north", 1: "east", 2: "south"}),
    ),
)
_orders_query(
    "F16_month_text",
    "strftime(order_date, '%Y-%m') AS month",
    lambda: dict(
        month=text.month_text("order_date"),
    ),
)

"""The logical tables again, as common table expressions for the SQL check."""

from __future__ import annotations

_CTES: dict[str, tuple[str, str]] = {
    "purchases": (
        "",
        """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount
        FROM orders""",
    ),
    "lines": (
        "purchases",
        """
        SELECT l.l_orderkey AS order_id, h.customer_id, h.order_date,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_amount,
               p.p_type AS product_category,
               CAST(l.l_discount AS DECIMAL(4,2)) >= 0.05 AS discount_used,
               CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2))
                    AS DECIMAL(18,2)) AS discount_value
        FROM lineitem l
        JOIN part p ON p.p_partkey = l.l_partkey
        JOIN purchases h ON h.order_id = l.l_orderkey""",
    ),
    "snapshot": ("purchases", "SELECT max(order_date) AS day FROM purchases"),
    "spend": (
        "purchases snapshot",
        """
        SELECT customer_id, count(*) AS total_orders,
               CAST(sum(order_amount) AS DECIMAL(18,2)) AS total_spent,
               max(order_date) AS last_order_date,
               count(*) FILTER (order_date > (SELECT day FROM snapshot) - 365) AS recent_orders
        FROM purchases GROUP BY customer_id""",
    ),
    "customers": (
        "spend",
        """
        SELECT c.c_custkey AS customer_id, c.c_name AS name,
               CASE WHEN c.c_custkey % 20 = 0 THEN 'Other' WHEN c.c_custkey % 2 = 0 THEN 'M'
                    ELSE 'F' END AS gender,
               CAST(18 + c.c_custkey % 63 AS INTEGER) AS age,
               n.n_name AS country,
               CASE WHEN c.c_acctbal < 4300 THEN 'Bronze' WHEN c.c_acctbal < 7950 THEN 'Silver'
                    WHEN c.c_acctbal < 9480 THEN 'Gold' ELSE 'Platinum' END AS customer_tier,
               DATE '1995-01-01' + CAST(c.c_custkey * 37 % 1826 AS INTEGER) AS signup_date,
               CAST(floor(((SELECT day FROM snapshot)
                    - (DATE '1995-01-01' + CAST(c.c_custkey * 37 % 1826 AS INTEGER))) / 30.0)
                    AS INTEGER) AS months_since_signup,
               (s.last_order_date IS NULL
                OR s.last_order_date < (SELECT day FROM snapshot) - 90) AS churned,
               CAST(0.30 * coalesce(s.total_spent, 0) AS DECIMAL(18,2)) AS clv,
               coalesce(s.recent_orders / CAST(s.total_orders AS DOUBLE), 0.0)
                   AS next_purchase_prob,
               CAST(coalesce(s.total_spent, 0) AS DECIMAL(18,2)) AS total_spent,
               coalesce(s.total_orders, 0) AS total_orders,
               s.last_order_date
        FROM customer c
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN spend s ON s.customer_id = c.c_custkey""",
    ),
    "gaps": (
        "",
        """
        SELECT user_id, event_type, ts,
               epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                   AS gap
        FROM events""",
    ),
    "engagement": (
        "gaps",
        f"""
        SELECT user_id AS customer_id,
               CAST(count(*) FILTER (event_type = 'view') * 7
                    // (SELECT max(CAST(ts AS DATE)) - min(CAST(ts AS DATE)) + 1 FROM events)
                    AS BIGINT) AS weekly_visits,
               CAST(round(CAST(coalesce(sum(gap) FILTER (gap <= 1800000000), 0) / 60000000.0
                    / (1 + count(*) FILTER (gap > 1800000000)) AS DECIMAL(38,6)), 4) AS DOUBLE)
                   AS session_time_minutes,
               count(*) FILTER (event_type = 'view') AS page_views,
               count(*) FILTER (event_type = 'click') AS app_opens
        FROM gaps GROUP BY user_id""",
    ),
    "first_day": (
        "",
        "SELECT user_id, min(CAST(ts AS DATE)) AS day FROM events GROUP BY user_id",
    ),
    "promotions": (
        "first_day",
        """
        SELECT f.user_id AS customer_id,
               CASE f.user_id % 5 WHEN 0 THEN 'Spring Offer' WHEN 1 THEN 'Member Week'
                    WHEN 2 THEN 'Flash Deal' WHEN 3 THEN 'Season Close'
                    ELSE 'Welcome Back' END AS campaign_name,
               (10 + 5 * ((f.user_id // 10) % 5)) / 100.0::DOUBLE AS discount,
               CAST((f.user_id // 5) % 2 AS INTEGER) AS variant,
               CAST(count(e.event_id) > 0 AS INTEGER) AS responded,
               CAST(coalesce(sum(CAST(e.value AS DECIMAL(18,2))), 0) AS DECIMAL(18,2))
                   AS additional_revenue
        FROM first_day f
        LEFT JOIN events e ON e.user_id = f.user_id AND e.event_type = 'purchase'
             AND CAST(e.ts AS DATE) <= f.day + 1
        GROUP BY f.user_id""",
    ),
}


def define(name: str, needs: str, body: str) -> None:
    """Add a common table expression that other reference texts may name."""
    if name in _CTES:
        raise ValueError(f"{name} is defined twice")
    _CTES[name] = (needs, body)


def with_tables(needs: str, body: str) -> str:
    """``body`` preceded by the expressions it needs, each after those it builds on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in _CTES[name][0].split():
                visit(other)
            ordered.append(name)

    for name in needs.split():
        visit(name)
    ctes = ",\n".join(f"{name} AS ({_CTES[name][1]}\n)" for name in ordered)
    recursive = "RECURSIVE " if "path" in ordered else ""
    return f"WITH {recursive}{ctes}\n{body}" if ctes else body


def r(expression: str, digits: int) -> str:
    """Round half up through a decimal, as the Spark side does."""
    return f"CAST(round(TRY_CAST({expression} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"

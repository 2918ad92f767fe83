"""The logical customer tables, derived from order, line, part, customer and event tables.

Every table is a lazy DataFrame. Facts are aggregated per customer before any
join, so that a customer with very many rows is one row by the time it is shuffled
for a join.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clientele.functions.calendar import epoch_micros, tenure_months
from clientele.functions.joins import lookup_join
from clientele.functions.numeric import first_match, money_sum, rounded
from clientele.sources.schemas import (
    ENGAGEMENT_BEHAVIOR,
    MARKETING_PROMOTIONS,
    MONEY,
)

# Fixed values of the mapping.
FIRST_SIGNUP = "1995-01-01"
SIGNUP_SPAN_DAYS = 1826
TIER_BALANCES = (("Bronze", 4300.0), ("Silver", 7950.0), ("Gold", 9480.0))
TOP_TIER = "Platinum"
CAMPAIGNS = ("Spring Offer", "Member Week", "Flash Deal", "Season Close", "Welcome Back")
DISCOUNT_FLOOR = 0.05
SESSION_GAP_MICROS = 30 * 60 * 1_000_000
GROSS_MARGIN = 0.30
CHURN_DAYS = 90
RECENT_DAYS = 365
RESPONSE_DAYS = 1


def purchases_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"),
    )


def priced_lines(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast(MONEY)
    discount = F.col("l_discount").cast("decimal(4,2)")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        price.alias("order_amount"),
        (discount >= DISCOUNT_FLOOR).alias("discount_used"),
        (price * discount).cast(MONEY).alias("discount_value"),
    )


def categories(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("part_id"), F.col("p_type").alias("product_category")
    )


def purchase_items(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One row per order line with its category and discount.

    Parts that occur in very many lines do not burden a single task.
    """
    return lookup_join(priced_lines(lineitem), categories(part), "part_id", "order_id").drop(
        "part_id"
    )


def item_totals(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Revenue and lines per part and discount flag, with the part's category.

    Lines are summed before they meet their part: one row per part joins.
    """
    summed = (
        priced_lines(lineitem)
        .groupBy("part_id", "discount_used")
        .agg(money_sum("order_amount").alias("amount"), F.count(F.lit(1)).alias("rows"))
    )
    return summed.join(categories(part), "part_id").drop("part_id")


def purchase_lines(items: DataFrame, purchases: DataFrame) -> DataFrame:
    """The lines with customer and date of their order."""
    return items.join(purchases.select("order_id", "customer_id", "order_date"), "order_id")


def category_orders(items: DataFrame, purchases: DataFrame) -> DataFrame:
    """One row per order and category: summed lines with the order's customer and date.

    Lines are summed before they meet their order, so an order with any number
    of lines brings no more rows to that join than there are categories.
    """
    summed = items.groupBy("order_id", "product_category").agg(
        money_sum("order_amount").alias("amount"),
        F.count(F.lit(1)).alias("rows"),
        F.min("order_amount").alias("low"),
        F.max("order_amount").alias("high"),
    )
    return summed.join(purchases.select("order_id", "customer_id", "order_date"), "order_id")


def spend_per_customer(purchases: DataFrame, snapshot: Column) -> DataFrame:
    """One row per buyer: orders, spend, last order and the share of recent orders."""
    recent = F.col("order_date") > F.date_sub(snapshot, RECENT_DAYS)
    return purchases.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum("order_amount").cast(MONEY).alias("total_spent"),
        F.max("order_date").alias("last_order_date"),
        F.count_if(recent).alias("recent_orders"),
    )


def event_slots(events: DataFrame) -> DataFrame:
    """Events summed per user and half-hour slot.

    Two events in one slot are never a session apart, so a slot's first and
    last time stand for all of its events. Summing happens before the shuffle,
    whatever the number of events of a user.
    """
    micros = epoch_micros("ts")
    kind = F.col("event_type")
    amount = F.col("value").cast(MONEY)
    return (
        events.select("user_id", micros.alias("at"), kind.alias("kind"), amount.alias("amount"))
        .groupBy("user_id", F.floor(F.col("at") / F.lit(SESSION_GAP_MICROS)).alias("slot"))
        .agg(
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.count_if(F.col("kind") == "view").alias("views"),
            F.count_if(F.col("kind") == "click").alias("clicks"),
            F.count_if(F.col("kind") == "purchase").alias("buys"),
            F.sum(F.when(F.col("kind") == "purchase", F.col("amount"))).alias("buy_amount"),
        )
    )


def behaviour_from_slots(
    slots: DataFrame, span_days: Column, response_days: int = RESPONSE_DAYS
) -> DataFrame:
    """One row per active user: engagement, campaign, arm and response.

    A gap above half an hour starts a new session. The arm depends on the user
    id alone, never on the outcome. A user responds by buying on the day of the
    first event or within ``response_days`` after it. Both windows have the
    partitioning of the final grouping, so the slots are shuffled once.
    """
    order = W.partitionBy("user_id").orderBy("slot")
    day = F.floor(F.col("first_at") / F.lit(86_400_000_000))
    prepared = slots.withColumns(
        {
            "gap": F.col("first_at") - F.lag("last_at").over(order),
            "since_start": day - F.first(day).over(order),
        }
    )
    held = F.when(F.col("gap") <= SESSION_GAP_MICROS, F.col("gap")).otherwise(F.lit(0))
    inside = F.col("since_start") <= response_days
    user = F.col("customer_id")
    names = F.array(*[F.lit(c) for c in CAMPAIGNS])
    return (
        prepared.groupBy(F.col("user_id").alias("customer_id"))
        .agg(
            F.sum("views").alias("page_views"),
            F.sum("clicks").alias("app_opens"),
            F.sum(F.col("last_at") - F.col("first_at") + held).alias("busy"),
            (F.lit(1) + F.count_if(F.col("gap") > SESSION_GAP_MICROS)).alias("sessions"),
            F.sum(F.when(inside, F.col("buys"))).alias("buys"),
            F.sum(F.when(inside, F.col("buy_amount"))).alias("buy_amount"),
        )
        .select(
            "customer_id",
            F.floor(F.col("page_views") * 7 / span_days).alias("weekly_visits"),
            rounded(F.col("busy") / F.lit(60_000_000.0) / F.col("sessions"), 4).alias(
                "session_time_minutes"
            ),
            "page_views",
            "app_opens",
            F.get(names, (user % len(CAMPAIGNS)).cast("int")).alias("campaign_name"),
            ((F.lit(10) + 5 * (F.floor(user / 10) % 5)) / F.lit(100.0)).alias("discount"),
            (F.floor(user / 5) % 2).cast("int").alias("variant"),
            (F.col("buys") > 0).cast("int").alias("responded"),
            F.coalesce("buy_amount", F.lit(0)).cast(MONEY).alias("additional_revenue"),
        )
    )


class Tables:
    """The logical tables of one data folder, each built on first use.

    A file's schema is read once per object; later readers name it, which
    spares them the job that looks into the footers.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, StructType] = {}

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        reader = self.spark.read
        if path in self._schemas:
            return reader.schema(self._schemas[path]).parquet(path)
        df = reader.parquet(path)
        self._schemas[path] = df.schema
        return df

    @cached_property
    def purchases(self) -> DataFrame:
        return purchases_from_orders(self.raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return purchase_items(self.raw("lineitem"), self.raw("part"))

    @cached_property
    def item_totals(self) -> DataFrame:
        return item_totals(self.raw("lineitem"), self.raw("part"))

    @cached_property
    def lines(self) -> DataFrame:
        return purchase_lines(self.items, self.purchases)

    @cached_property
    def category_orders(self) -> DataFrame:
        return category_orders(self.items, self.purchases)

    def snapshot(self) -> Column:
        """The last order date, as a scalar subquery."""
        return self.purchases.agg(F.max("order_date")).scalar()

    @cached_property
    def behaviour(self) -> DataFrame:
        """Engagement and promotions side by side, from one pass over the events."""
        events = self.raw("events")
        day = F.col("ts").cast("date")
        span = events.agg(F.datediff(F.max(day), F.min(day)) + 1).scalar()
        return behaviour_from_slots(event_slots(events), span)

    @cached_property
    def engagement(self) -> DataFrame:
        return self.behaviour.select(*ENGAGEMENT_BEHAVIOR.fieldNames())

    @cached_property
    def promotions(self) -> DataFrame:
        return self.behaviour.select(*MARKETING_PROMOTIONS.fieldNames())

    @cached_property
    def demographics(self) -> DataFrame:
        """Customer attributes that need no purchase; the nation table has a fixed 25 rows.

        A customer of no known nation has a null country.
        """
        key = F.col("c_custkey")
        tier = first_match(
            [(F.col("c_acctbal") < limit, name) for name, limit in TIER_BALANCES], TOP_TIER
        )
        signup = F.date_add(
            F.lit(FIRST_SIGNUP).cast("date"), (key * 37 % SIGNUP_SPAN_DAYS).cast("int")
        )
        gender = first_match([(key % 20 == 0, "Other"), (key % 2 == 0, "M")], "F")
        nations = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
        )
        return (
            self.raw("customer")
            .join(F.broadcast(nations), "c_nationkey", "left")
            .select(
                key.alias("customer_id"),
                F.col("c_name").alias("name"),
                gender.alias("gender"),
                (F.lit(18) + key % 63).cast("int").alias("age"),
                "country",
                tier.alias("customer_tier"),
                signup.alias("signup_date"),
                tenure_months(signup, self.snapshot()).alias("months_since_signup"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Profiles with churn label, lifetime value and purchase probability."""
        snapshot = self.snapshot()
        spend = spend_per_customer(self.purchases, snapshot)
        last = F.col("last_order_date")
        orders = F.coalesce("total_orders", F.lit(0))
        spent = F.coalesce("total_spent", F.lit(0)).cast(MONEY)
        return self.demographics.join(spend, "customer_id", "left").select(
            *self.demographics.columns,
            (last.isNull() | (last < F.date_sub(snapshot, CHURN_DAYS))).alias("churned"),
            (F.lit(GROSS_MARGIN).cast("decimal(4,2)") * spent).cast(MONEY).alias("clv"),
            F.coalesce(
                F.col("recent_orders") / F.col("total_orders").cast("double"), F.lit(0.0)
            ).alias("next_purchase_prob"),
            spent.alias("total_spent"),
            orders.alias("total_orders"),
            last,
        )

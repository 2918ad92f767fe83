import datetime

from clientele.operators import revenue, rfm

D = datetime.date(2023, 5, 2)


def test_rows_of_one_order_are_one_order(spark):
    rows = [(7, 1, D, 10.0), (7, 1, D, 20.0), (7, 2, D, 60.0)]
    purchases = spark.createDataFrame(
        rows, "customer_id long, order_id long, order_date date, order_amount double"
    ).withColumn("order_amount", revenue.F.col("order_amount").cast("decimal(12,2)"))
    spend = revenue.customer_spend(purchases).first()
    assert (spend.total_orders, spend.total_spent, spend.avg_order_value) == (2, 90.0, 30.0)
    month = revenue.monthly_revenue(purchases).first()
    assert (month.total_orders, month.unique_buyers, month.avg_order_value) == (2, 1, 30.0)
    assert rfm.rfm_values(purchases).first().frequency == 3
    assert rfm.rfm_values(purchases, order_id="order_id").first().frequency == 2

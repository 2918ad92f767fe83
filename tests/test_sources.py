import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clientele.sources import readers, schemas, sinks
from clientele.sources.adapter import behaviour_from_slots, event_slots
from clientele.sources.scratch import materialise, scratch_path, shared_folder


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "customer_id long")
    with pytest.raises(ValueError, match="order_amount, order_date"):
        schemas.require_columns(df, ["customer_id", "order_date", "order_amount"])


def test_delimited_round_trip(spark):
    rows = [(1, 7, datetime.date(2023, 1, 2)), (2, 8, None)]
    df = spark.createDataFrame(rows, "order_id long, customer_id long, order_date date").withColumn(
        "order_amount", F.lit("12.50").cast("decimal(18,2)")
    )
    path = scratch_path(spark, "t")
    sinks.write_report(df, path)
    back = readers.read_delimited(spark, path, schemas.PURCHASE_HISTORY)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_header_is_checked(spark):
    path = scratch_path(spark, "t")
    sinks.write_report(spark.createDataFrame([(1, 2)], "customer_id long, order_id long"), path)
    wrong = schemas.PURCHASE_HISTORY[:2]
    with pytest.raises(Exception, match="(?i)header|schema"):
        readers.read_delimited(spark, path, wrong).collect()


def test_columnar_needs_all_columns(spark):
    path = scratch_path(spark, "t")
    sinks.write_report(spark.createDataFrame([(1,)], "order_id long"), path, "parquet")
    with pytest.raises(ValueError, match="customer_id"):
        readers.read_columnar(spark, path, schemas.PURCHASE_HISTORY)


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        sinks.write_report(spark.range(1), scratch_path(spark, "t"), "xlsx")


def test_lenient_date(spark):
    df = spark.createDataFrame([("2023-02-01",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(readers.lenient_date("t")).collect()]
    assert got == [datetime.date(2023, 2, 1), None, None]


def test_views_counts_and_schema(spark):
    tables = {"t_a": spark.range(3), "t_b": spark.range(5).withColumn("x", F.lit("y"))}
    readers.register_views(tables)
    assert spark.table("t_a").count() == 3
    assert {tuple(r) for r in readers.row_counts(tables).collect()} == {("t_a", 3), ("t_b", 5)}
    listed = readers.schema_listing(tables).collect()
    assert [(r.table_name, r.column_name, r.column_type) for r in listed] == [
        ("t_a", "id", "bigint"),
        ("t_b", "id", "bigint"),
        ("t_b", "x", "string"),
    ]


def test_json_summary(spark):
    comparison = spark.createDataFrame(
        [("a", "s", 0.7, 0.6, 0.5), ("b", "s", 0.8, 0.5, 0.4), ("a", "o", 0.6, 0.6, 0.6)],
        "model string, split string, roc_auc double, f1 double, accuracy double",
    )
    importances = spark.createDataFrame(
        [(f"f{i}", i / 10) for i in range(8)], "feature string, importance double"
    )
    path = scratch_path(spark, "summary")
    sinks.write_json_summary(sinks.model_summary(comparison, importances, 3), path)
    (line,) = [p.read_text() for p in Path(path).glob("*.json")]
    summary = json.loads(line)
    assert summary["best_models"]["s"]["model"] == "b"
    assert summary["best_models"]["o"]["roc_auc"] == 0.6
    assert [f["feature"] for f in summary["top_features"]] == ["f7", "f6", "f5"]


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert materialise(spark.range(4)).count() == 4


def test_a_session_without_shared_folder_gets_one_temporary_folder():
    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "local[1]"

            @staticmethod
            def getConf():
                return Bare.conf

    assert shared_folder(Bare) == shared_folder(Bare)
    assert Path(shared_folder(Bare)).is_dir()
    Bare.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare)


def _events(hot=3000):
    """One user with far more events than all others together, bursts and gaps."""
    rows, start = [], datetime.datetime(2024, 1, 1, 0, 0, 1)
    for i in range(hot):
        gap = 17 * (i % 90) if i % 50 else 3600
        start += datetime.timedelta(seconds=gap)
        rows.append((len(rows), start, 1, ("view", "click", "purchase")[i % 3], 2.5))
    for user in range(2, 40):
        for k in range(5):
            at = datetime.datetime(2024, 1, 1 + (user + k) % 20, user % 24, (k * 29) % 60, k)
            rows.append((len(rows), at, user, ("view", "purchase")[k % 2], 1.25))
    return rows


def test_sessions_of_a_hot_user_equal_brute_force(spark):
    rows = _events()
    df = spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    ).repartition(4)
    got = {
        r.customer_id: r
        for r in behaviour_from_slots(event_slots(df), F.lit(30)).collect()
    }
    limit = datetime.timedelta(minutes=30)
    for user in {r[2] for r in rows}:
        own = sorted(r[1] for r in rows if r[2] == user)
        gaps = [b - a for a, b in zip(own, own[1:])]
        sessions = 1 + sum(g > limit for g in gaps)
        minutes = sum((g for g in gaps if g <= limit), datetime.timedelta()).total_seconds() / 60
        assert got[user].session_time_minutes == pytest.approx(minutes / sessions, abs=1e-4)
        views = sum(r[2] == user and r[3] == "view" for r in rows)
        assert got[user].page_views == views
        assert got[user].weekly_visits == views * 7 // 30
        until = own[0].date() + datetime.timedelta(days=1)
        bought = [r[4] for r in rows if r[2] == user and r[3] == "purchase" and r[1].date() <= until]
        assert got[user].responded == int(bool(bought))
        assert float(got[user].additional_revenue) == pytest.approx(sum(bought))

from datetime import timedelta

from pyspark.sql import functions as F

from conftest import folders_read, plan, utc, values
from marketpulse import operators
from marketpulse.operators import bars, keep_best, latest_versions, top_per_group

DAY = "2026-02-19T"


def ticks(spark, *rows):
    return spark.createDataFrame(
        [(s, p, utc(DAY + t), n) for s, p, t, n in rows],
        "symbol string, price double, event_time timestamp, seq long",
    )


def test_bars_follow_event_time_then_arrival(spark):
    t = ticks(
        spark, ("A", 3.0, "10:00:30", 1), ("A", 1.0, "10:00:10", 2), ("A", 9.0, "10:00:20", 3),
        ("A", 7.0, "10:00:10", 1), ("A", 4.0, "10:00:30", 7), ("A", 5.0, "10:01:00", 8),
        ("B", None, "10:00:00", 9), ("B", 2.0, "10:00:59.999999", 10),
    )
    expected = [
        ("A", "2026-02-19 10:00:00", 7.0, 9.0, 1.0, 4.0, 4.8, 5),
        ("A", "2026-02-19 10:01:00", 5.0, 5.0, 5.0, 5.0, 5.0, 1),
        ("B", "2026-02-19 10:00:00", 2.0, 2.0, 2.0, 2.0, 2.0, 1),
    ]
    assert values(bars(t)) == expected
    assert values(bars(t.repartition(7))) == expected


def test_short_and_long_bars_agree_on_order(spark):
    t = ticks(
        spark, ("A", 1.0, "00:00:00", 5), ("A", 2.0, "00:00:00", 3), ("A", 3.0, "23:59:59.999999", 2),
        ("A", 4.0, "23:59:59.999999", 2**31 - 1),
    )
    day = values(bars(t, timedelta(days=1)), "open_price", "close_price", "trade_count")
    assert day == [(2.0, 4.0, 4)]
    half_hour = bars(t, timedelta(minutes=30)).orderBy("minute_bucket").collect()
    assert [(r.open_price, r.close_price) for r in half_hour] == [(2.0, 1.0), (3.0, 4.0)]


def test_arrival_order_holds_for_every_offset(spark):
    for low in (2**31 - 1, 2**31, 2**40, 2**62):
        t = ticks(spark, ("A", 1.0, "10:00:59.999999", low), ("A", 2.0, "10:00:59.999999", low + 1))
        for every in (timedelta(minutes=1), timedelta(days=1)):
            row = bars(t, every).first()
            assert (row.open_price, row.close_price) == (1.0, 2.0)


def test_one_partition_follows_the_other(spark):
    t = ticks(spark, ("A", 1.0, "23:59:59", 2**62), ("A", 2.0, "23:59:59", 5), ("A", 3.0, "00:00:00", 9))
    t = t.withColumn("part", F.when(F.col("seq") == 5, 900_000).otherwise(1))
    row = bars(t, timedelta(days=1)).first()
    assert (row.open_price, row.close_price) == (3.0, 2.0)


def test_bars_aggregate_by_hash_before_the_shuffle(spark):
    text = plan(bars(ticks(spark, ("A", 1.0, "10:00:00", 1))))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert text.count("Exchange") == 1


def test_hot_group_is_cut_before_the_shuffle(spark):
    rows = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    best = keep_best(rows, ["k"], [F.desc("id")])
    text = plan(best)
    exchange = text.index("Exchange hashpartitioning")
    assert text.index("WindowGroupLimit") < exchange < text.rindex("WindowGroupLimit")
    assert best.where("k = 'hot'").first().id == 9999
    assert best.count() == 6667


def test_top_per_group(spark):
    rows = spark.createDataFrame([("a", n) for n in range(12)] + [("b", 1)], "g string, n int")
    top = top_per_group(rows, ["g"], [F.desc("n")], 10)
    assert values(top.where("g = 'a'"), "n", "rank") == sorted(
        [(11 - i, i + 1) for i in range(10)], key=repr
    )
    assert top.where("g = 'b'").count() == 1


def test_latest_versions(spark):
    rows = spark.createDataFrame(
        [("A", 1, 0, 5.0, 1), ("A", 1, 2, None, 2), ("A", 1, 1, 6.0, 3), ("A", 2, 1, 1.0, 4)],
        "symbol string, m int, batch_id long, x double, n int",
    )
    latest = latest_versions(rows, ["symbol", "m"])
    assert values(latest) == [("A", 1, None, 2), ("A", 2, 1.0, 4)]
    assert "SortAggregate" not in plan(latest)


def priced(spark):
    rows = [
        ("BTC-USD", 100.0, "2026-02-17"), ("BTC-USD", 110.0, "2026-02-18"), ("BTC-USD", 112.0, "2026-02-18"),
        ("ETH-USD", 5.0, "2026-02-18"), ("BTC-USD", 50.0, "2026-02-20"), ("ETH-USD", 6.0, "2026-02-21"),
        ("BTC-USD", 50.0, "2026-02-21"),
    ]
    return spark.createDataFrame(
        [(s, p, utc(d + "T23:59:59.999999")) for s, p, d in rows],
        "symbol string, price double, event_time timestamp",
    )


def test_daily_averages(spark):
    daily = operators.symbol_daily_avg(priced(spark))
    assert values(daily) == [
        ("2026-02-17", 100.0, None, None), ("2026-02-18", 111.0, 5.0, None),
        ("2026-02-20", 50.0, None, None), ("2026-02-21", 50.0, 6.0, None),
    ]


def test_change_needs_the_day_before(spark):
    changes = operators.day_over_day(priced(spark), "BTC-USD")
    assert values(changes) == [
        ("2026-02-17", 100.0, None), ("2026-02-18", 111.0, 11.0),
        ("2026-02-20", 50.0, None), ("2026-02-21", 50.0, 0.0),
    ]
    assert plan(changes).count("Scan") == 1 and "Join" not in plan(changes)


def test_one_day_matches_all_days(spark):
    everything = operators.change_of_day(operators.symbol_daily_avg(priced(spark)))
    for day in ("2026-02-17", "2026-02-18", "2026-02-21"):
        alone = operators.day_prices(priced(spark), day)
        assert values(alone) == values(everything.where(F.col("report_date") == day), *alone.columns)
    assert values(operators.day_prices(priced(spark), "2030-01-01")) == [(None, None, None, None)]


def test_day_condition_reaches_the_scan(spark, tmp_path):
    priced(spark).write.parquet(f"{tmp_path}/p")
    day = operators.by_day(spark.read.parquet(f"{tmp_path}/p"), "2026-02-18")
    assert day.count() == 3
    assert "GreaterThanOrEqual(event_time" in plan(day)


def test_a_day_opens_its_folder_only(spark, tmp_path):
    days = spark.range(30).select(
        F.lit("BTC-USD").alias("symbol"), F.col("id").cast("double").alias("price"),
        F.expr("timestamp '2026-01-01 12:00:00' + make_dt_interval(id)").alias("event_time"),
    )
    days.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(f"{tmp_path}/p")
    table = spark.read.parquet(f"{tmp_path}/p")
    assert folders_read(operators.by_day(table, "2026-01-15")) == 1
    both = operators.day_prices(table, "2026-01-15")
    assert folders_read(both) == 2
    assert values(both, "btc_avg_price", "btc_price_change") == [(14.0, 7.69)]


def test_ticks_of_more_days_than_an_expression_can_list(spark, tmp_path):
    first = utc("2020-01-01T12:00:00")
    rows = [("A", float(n), first + timedelta(n)) for n in (0, 1, 2, 1498, 1499, 1500, 2500)] + [("A", 0.5, None)]
    made = spark.createDataFrame(rows, "symbol string, price double, event_time timestamp")
    days = [(first + timedelta(n)).date() for n in range(1500) if n != 2]
    kept = operators.prices.of_days(made, *map(F.lit, days))
    assert values(kept, "price") == [(0.0,), (1.0,), (1498.0,), (1499.0,)]
    made.where("price < 2000").withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(f"{tmp_path}/t")
    kept = operators.prices.of_days(spark.read.parquet(f"{tmp_path}/t"), *map(F.lit, days))
    assert folders_read(kept) == 4 and kept.count() == 4
    assert operators.by_day(made, "2020-01-03").count() == 1

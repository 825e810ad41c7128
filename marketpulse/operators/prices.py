"""Daily price averages and their change."""

from pyspark.sql import functions as F

from marketpulse.functions import percent_change

# The tracked products and their short names.
PRODUCTS = {"btc": "BTC-USD", "eth": "ETH-USD", "sol": "SOL-USD"}


def of_days(ticks, *days):
    """Ticks of some dates, one or thousands. Their bounds reach the parquet scan; in a table
    with `event_date` folders the others are not opened."""
    if "event_date" in ticks.columns:
        ticks = ticks.where(F.col("event_date").isin(*days))
    day, every = F.to_date("event_time"), F.array(*days)
    return ticks.where(day.between(F.array_min(every), F.array_max(every)) & day.isin(*days))


def by_day(ticks, day):
    """The ticks of one day."""
    return of_days(ticks, F.lit(day).cast("date"))


def _averages(products):
    return [
        F.avg(F.when(F.col("symbol") == symbol, F.col("price"))).alias(f"{name}_avg_price")
        for name, symbol in products.items()
    ]


def symbol_daily_avg(ticks, products=PRODUCTS):
    """One row per day with one average per tracked product (NULL without ticks)."""
    return (
        ticks.withColumn("report_date", F.to_date("event_time"))
        .groupBy("report_date")
        .agg(*_averages(products))
    )


def change_of_day(daily, name="btc"):
    """Add the change of one product against the day before, NULL when that day is missing.

    Each day's average is sent to its own date and to the next one, and both meet in one
    small aggregation. A self-join on the previous date would scan the ticks twice.
    """
    average = f"{name}_avg_price"
    own = [c for c in daily.columns if c != "report_date"]
    spread = daily.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("report_date"),
                    F.struct(*own).alias("own"),
                    F.lit(None).cast("double").alias("before"),
                ),
                F.struct(
                    F.date_add("report_date", 1).alias("report_date"),
                    F.lit(None).alias("own"),
                    F.col(average).alias("before"),
                ),
            )
        )
    )
    return (
        spread.groupBy("report_date")
        .agg(F.max("own").alias("own"), F.max("before").alias("before"))
        .where(F.col("own").isNotNull())
        .select(
            "report_date", "own.*",
            percent_change(F.col(f"own.{average}"), F.col("before")).alias(f"{name}_price_change"),
        )
    )


def day_over_day(ticks, symbol):
    """Average price of one symbol per day and its change against the day before."""
    daily = symbol_daily_avg(ticks.where(F.col("symbol") == symbol), {"day": symbol})
    return change_of_day(daily, "day").select(
        "report_date",
        F.col("day_avg_price").alias("avg_price"),
        F.col("day_price_change").alias("price_change"),
    )


def day_prices(ticks, day, products=PRODUCTS, change_of="btc"):
    """The averages of one day and the change against the day before, always as one row.

    Both days are read in one scan; the earlier day only counts towards the change.
    """
    day = F.lit(day).cast("date")
    date = F.to_date("event_time")
    two_days = of_days(ticks, day, F.date_sub(day, 1))

    def mean(symbol, on):
        return F.avg(F.when((F.col("symbol") == symbol) & (date == on), F.col("price")))

    means = [mean(s, day).alias(f"{name}_avg_price") for name, s in products.items()]
    before = mean(products[change_of], F.date_sub(day, 1)).alias("before")
    now = F.col(f"{change_of}_avg_price")
    return two_days.agg(*means, before).select(
        *[f"{name}_avg_price" for name in products],
        percent_change(now, F.col("before")).alias(f"{change_of}_price_change"),
    )

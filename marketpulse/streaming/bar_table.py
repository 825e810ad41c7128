"""The table of changed bars: a base per day and the changes since.

The stream adds a folder of changed bars per day and micro-batch, `bar_date=` and `batch_id=`.
Merging puts the latest version of each bar of a day into a base, below `_bases`, and names it
as the day's current one together with the last micro-batch in it; readers open the base and
the folders of later micro-batches. Only micro-batches that the stream has committed are
merged, so that none is repeated afterwards.
"""

from datetime import date

from pyspark.sql import functions as F

from marketpulse.operators import bars, latest_versions
from marketpulse.operators.bars import MINUTE
from marketpulse.schemas import BAR_UPDATES
from marketpulse.sinks import pointers

BASES = "_bases"
KEYS = ["symbol", "minute_bucket"]


def _days(names, since, until):
    since, until = str(since or ""), str(until or "9999-12-31")
    return [d for d in names if since <= d <= until]


def _bases(spark, path):
    """{day: (version, last micro-batch in it)}"""
    return {
        day: (version, int(version.rsplit("-", 1)[1]))
        for day, version in pointers.current(spark, path).items()
    }


def _changes(spark, path, bases, since=None, until=None):
    """{day: [micro-batches that its base does not hold]}"""
    found = {}
    for folder, batch in pointers.matching(spark, f"{path}/bar_date=*/batch_id=*", 2):
        day, number = folder.split("=")[1], int(batch.split("=")[1])
        if number > bases.get(day, ("", -1))[1]:
            found.setdefault(day, []).append(number)
    return {day: found[day] for day in _days(found, since, until)}


def _read(spark, root, paths):
    if not paths:
        return spark.createDataFrame([], BAR_UPDATES)
    rows = spark.read.schema(BAR_UPDATES).option("basePath", root).parquet(*paths)
    return rows.select(*BAR_UPDATES.fieldNames())


def _stored(spark, path, bases, changes):
    """The rows of some bases and of some change folders; others are not opened."""
    kept = [f"{path}/{BASES}/version={version}/bar_date={day}" for day, (version, _) in bases.items()]
    new = [f"{path}/bar_date={day}/batch_id={n}" for day, numbers in changes.items() for n in numbers]
    return _read(spark, f"{path}/{BASES}", kept).unionAll(_read(spark, path, new))


def bar_updates(spark, path, since=None, until=None):
    """The bases and all changes since, or those of the days from `since` to `until`."""
    bases = _bases(spark, path)
    changes = _changes(spark, path, bases, since, until)
    held = {day: bases[day] for day in _days(bases, since, until) if not bases[day][0].startswith("none")}
    return _stored(spark, path, held, changes)


def latest_bars(spark, path, since=None, until=None):
    rows = bar_updates(spark, path, since, until).drop("bar_date")
    return latest_versions(rows, KEYS)


def committed_batch(spark, checkpoint):
    """The last micro-batch that the stream has committed, -1 before the first."""
    return max((int(n) for n in pointers.names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def _new_bases(rows, path, upto):
    """Write the bars in `rows` as new bases that hold the changes up to these micro-batches
    ({day: number}) and make them current. A day without bars gets a base without rows."""
    spark, name = rows.sparkSession, pointers.new_version()
    for number in sorted(set(upto.values())):
        version, days = f"{name}-{number}", [d for d, n in upto.items() if n == number]
        here = rows.where(F.col("bar_date").isin([date.fromisoformat(d) for d in days]))
        here = here.withColumns({"batch_id": F.lit(number).cast("long"), "version": F.lit(version)})
        here.hint("rebalance", "bar_date").write.mode("append").partitionBy("version", "bar_date").parquet(f"{path}/{BASES}")
        written = {d.split("=")[1] for d in pointers.names(spark, f"{path}/{BASES}/version={version}") if "=" in d}
        pointers.switch(spark, path, {d: version if d in written else f"none-{number}" for d in days})


def merge_bars(spark, path, checkpoint, since=None, until=None, least=2):
    """Merge the days that have at least `least` folders of committed changes, and remove what
    has been merged. Gives the merged days. The stream may run meanwhile: it only adds
    micro-batches after those merged here."""
    last, bases = committed_batch(spark, checkpoint), _bases(spark, path)
    changes = {
        day: [n for n in numbers if n <= last]
        for day, numbers in _changes(spark, path, bases, since, until).items()
    }
    changes = {day: numbers for day, numbers in changes.items() if len(numbers) >= least}
    if changes:
        held = {day: bases[day] for day in changes if day in bases and not bases[day][0].startswith("none")}
        rows = latest_versions(_stored(spark, path, held, changes), [*KEYS, "bar_date"])
        _new_bases(rows, path, {day: max(numbers) for day, numbers in changes.items()})
        drop_merged(spark, path, list(changes))
    return sorted(changes)


def drop_merged(spark, path, days):
    """Remove the changes that the bases of these days hold, and the bases before them."""
    bases = _bases(spark, path)
    for day in days:
        last = bases.get(day, ("", -1))[1]
        for folder in pointers.names(spark, f"{path}/bar_date={day}"):
            if folder.startswith("batch_id=") and int(folder.split("=")[1]) <= last:
                pointers.remove(spark, f"{path}/bar_date={day}/{folder}")
    for day, version in pointers.forget(spark, path, set(days)):
        pointers.remove(spark, f"{path}/{BASES}/version={version}/bar_date={day}")


def rebuild_bars(silver, path, days, width=MINUTE):
    """The bars of one day, or of a list of days, anew from silver, in place of their base and
    all their changes: ticks that came too late for the stream count. For days that the
    watermark has passed; `width` must divide a day."""
    spark = silver.sparkSession
    days = [str(d) for d in (days if isinstance(days, (list, tuple, set)) else [days])]
    if not days:
        return
    bases = _bases(spark, path)
    changes = _changes(spark, path, bases)
    upto = {d: max([bases.get(d, ("", -1))[1], *changes.get(d, [])]) for d in days}
    wanted = [F.lit(date.fromisoformat(d)) for d in days]
    ticks = silver.where(F.to_date("event_time").isin(wanted))
    if "event_date" in silver.columns:
        ticks = ticks.where(F.col("event_date").isin(wanted))
    rows = bars(ticks, width).withColumn("bar_date", F.to_date("minute_bucket"))
    _new_bases(rows, path, upto)


def bar_differences(silver, table, width=MINUTE):
    """The bars whose ticks in silver are not those in the table: symbol, minute_bucket,
    in_silver and in_bars (ticks), and missing (ticks that the table lacks).

    Both sides are reduced to counts, lowest and highest price and average per bar before
    they meet in one full outer join."""
    def digest(rows, side):
        kept = {"trade_count": f"in_{side}", "avg_price": f"avg_{side}", "low_price": f"low_{side}", "high_price": f"high_{side}"}
        return rows.select(*KEYS, *(F.col(c).alias(name) for c, name in kept.items()))

    both = digest(bars(silver, width), "silver").join(digest(table, "bars"), KEYS, "full_outer")
    same = [F.col(f"{c}_silver").eqNullSafe(F.col(f"{c}_bars")) for c in ("in", "avg", "low", "high")]
    counts = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("in_silver", "in_bars")}
    return both.where(~(same[0] & same[1] & same[2] & same[3])).withColumns(counts).select(
        *KEYS, "in_silver", "in_bars", (F.col("in_silver") - F.col("in_bars")).alias("missing")
    )


def heal_bars(spark, silver, path, before, width=MINUTE):
    """Rebuild the days before `before` (the first day that the watermark has not passed)
    whose bars lack ticks that silver has; gives these days. Other days are compared and
    left as they are."""
    def earlier(rows, column):
        return rows.where(F.to_date(column) < F.lit(str(before)).cast("date"))

    odd = bar_differences(earlier(silver, "event_time"), earlier(latest_bars(spark, path), "minute_bucket"), width)
    days = odd.select(F.to_date("minute_bucket").cast("string").alias("day")).distinct()
    days = sorted(r.day for r in days.collect())  # one row per day
    rebuild_bars(silver, path, days, width)
    return days

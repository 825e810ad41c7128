"""Tables with one folder per day, whose days are replaced whole.

A day's rows lie in `<table>/<day column>=<day>/version=<version>`. A write adds a new version
aside of the current one, then `pointers` names it as the current one, then the earlier one
goes. A write that fails, or a driver that dies at any step, leaves the day's old rows or its
new ones. A day without rows points to no folder.

When more than `GROUP` days of a parquet table are replaced at once, folders and files per day
would take most of the time. So many neighbouring days share files: their rows lie in
`<table>/_together/<version>/days_group=<number>`, `_days` beside the groups lists the days, and
all days switch at once. A day's version is then `<version>_<number>`. Readers leave out the
days that have another version by now; a group goes when all of its days have.
"""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.sinks import pointers

VERSION = "version"
NOTHING = "none"
GROUP = 64  # days that share files when more are replaced at once
GROUPED = "days_group"
TOGETHER = "_together"
DAYS = "_days"


def replace_days(rows, table, days=None, day_column="report_date", kind="parquet", notes=None, few=False,
                 gathered=False):
    """Make `rows` the content of `days`. Rows of other days are left out. Without a list,
    the days that occur in `rows` are replaced. `notes` ({day: text}) go into the names of
    their versions, after a hyphen. With `few` rows a day it is the folders that take the time,
    and every core writes some of the days. Rows `gathered` by day, as those read from another
    table of the same days, are not shuffled when many days share files."""
    spark, version = rows.sparkSession, pointers.new_version()
    if days is not None:
        days = [date.fromisoformat(d) if isinstance(d, str) else d for d in days]
        if kind == "parquet" and len(set(days)) > GROUP:
            wanted = _write_groups(rows, table, days, day_column, version, notes, few, gathered)
            pointers.switch_together(spark, table, wanted)
            drop_superseded(spark, table, wanted, day_column)
            return
        rows = rows.where(F.col(day_column).isin(days))
    rows = _with_version(rows, version, notes, day_column)
    if few and days is not None and len(days) > 1:
        rows = rows.repartition(min(len(days), spark.sparkContext.defaultParallelism), day_column)
    elif days is None or len(days) > 1:
        # Bring each day's rows together before the per-day folders; AQE splits big days.
        rows = rows.hint("rebalance", day_column)
    writer = rows.write.mode("append")
    writer.partitionBy(day_column, VERSION).format(kind).save(table)
    written = pointers.matching(spark, f"{table}/{day_column}=*/{VERSION}={version}*", 2)
    written = {folder.split("=", 1)[1]: name.split("=", 1)[1] for folder, name in written}
    wanted = written if days is None else {str(d): written.get(str(d), NOTHING) for d in days}
    pointers.switch(spark, table, wanted)
    drop_superseded(spark, table, wanted, day_column)


def _with_version(rows, version, notes, day_column):
    """Rows with the version of their day. The notes are looked up by day in a small table:
    written into the expression, those of many days make it too large to compile."""
    if not notes:
        return rows.withColumn(VERSION, F.lit(version))
    noted = [(str(day), f"{version}-{note}") for day, note in notes.items()]
    noted = rows.sparkSession.createDataFrame(noted, f"day string, {VERSION} string")
    noted = F.broadcast(noted.select(F.col("day").cast("date").alias(day_column), VERSION))
    return rows.join(noted, day_column, "left").fillna(version, [VERSION])


def _write_groups(rows, table, days, day_column, version, notes, few, gathered):
    """Write the days in groups; gives the version of each day. The days are listed before the
    rows are written: whoever finds rows that nothing names knows whose they are."""
    spark, place = rows.sparkSession, f"{table}/{TOGETHER}/{version}"
    group = {str(day): n // GROUP for n, day in enumerate(sorted(set(days)))}
    pointers.write_text(spark, f"{place}/{DAYS}", "\n".join(group))
    numbers = spark.createDataFrame(list(group.items()), f"day string, {GROUPED} int")
    numbers = F.broadcast(numbers.select(F.col("day").cast("date").alias(day_column), GROUPED))
    rows = rows.join(numbers, day_column)
    if few:
        parts = min(1 + max(group.values()), spark.sparkContext.defaultParallelism)
        rows = rows.repartition(parts, GROUPED)
    elif not gathered:
        rows = rows.hint("rebalance", GROUPED)  # AQE splits big groups
    rows.write.mode("append").partitionBy(GROUPED).parquet(place)
    held = spark.read.schema(f"{day_column} date").parquet(place).distinct().collect()  # one row per day
    notes = {str(day): f"-{note}" for day, note in (notes or {}).items()}
    wanted = dict.fromkeys(group, NOTHING)
    for day in sorted(str(row[0]) for row in held):
        wanted[day] = f"{version}_{group[day]}{notes.get(day, '')}"
    return wanted


def drop_superseded(spark, table, days, day_column="report_date"):
    """Remove the versions of these days that are no longer current, with those that a writer
    has left without pointing to them."""
    now = pointers.current(spark, table)

    def drop(day):
        for folder in pointers.names(spark, f"{table}/{day_column}={day}"):
            if folder.startswith(f"{VERSION}=") and folder != f"{VERSION}={now.get(day)}":
                pointers.remove(spark, f"{table}/{day_column}={day}/{folder}")

    alone = days
    if len(days) > GROUP:
        folders = set(pointers.names(spark, table))
        alone = [day for day in days if f"{day_column}={day}" in folders]
    pointers.each(drop, alone)
    _drop_groups(spark, f"{table}/{TOGETHER}", set(days), now)
    pointers.forget(spark, table, set(days))


def _drop_groups(spark, folder, days, now):
    """Remove the groups that nothing names, where they hold a day of these: a day has one
    writer, so theirs has ended. Groups without any such day may still be in the making."""
    named = {version.split("-")[0] for version in now.values()}
    for version in pointers.names(spark, folder):
        held = pointers.read_text(spark, f"{folder}/{version}/{DAYS}")
        if held is None or days.isdisjoint(held.split()):
            continue
        groups = [name for name in pointers.names(spark, f"{folder}/{version}") if name.startswith(f"{GROUPED}=")]
        unnamed = [name for name in groups if f"{version}_{name.split('=')[1]}" not in named]
        if len(unnamed) == len(groups):
            pointers.remove(spark, f"{folder}/{version}")
        else:
            pointers.each(lambda name: pointers.remove(spark, f"{folder}/{version}/{name}"), unnamed)


def read_days(spark, table, schema, day_column="report_date", day=None, kind="parquet", days=None):
    """The rows of the table, or of one day, or of a list of days; none if the table does
    not exist yet."""
    wanted = days if day is None else [day]
    wanted = wanted if wanted is None else {str(d) for d in wanted}
    paths, groups = [], {}
    for d, version in pointers.current(spark, table).items():
        if version == NOTHING or (wanted is not None and d not in wanted):
            continue
        written, together, number = version.split("-")[0].partition("_")
        if together:
            groups.setdefault(written, {}).setdefault(number, []).append(d)
        else:
            paths.append(f"{table}/{day_column}={d}/{VERSION}={version}")
    parts = [_read_groups(spark, table, schema, day_column, *group) for group in groups.items()]
    if paths:
        rows = spark.read.schema(schema).option("basePath", table).format(kind).load(paths)
        if day is not None:
            rows = rows.where(F.col(day_column) == F.lit(day).cast("date"))
        parts.append(rows.select(*schema.fieldNames()))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def _read_groups(spark, table, schema, day_column, version, groups):
    """Some days of some groups, {number: days}, that were written together."""
    rows = spark.read.schema(schema).parquet(*(f"{table}/{TOGETHER}/{version}/{GROUPED}={n}" for n in groups))
    days = ", ".join(f"DATE'{day}'" for own in groups.values() for day in own)
    return rows.where(f"`{day_column}` IN ({days})").select(*schema.fieldNames())


def replace_folders(rows, table, *columns):
    """Write the folders that `rows` has values for; other folders stay. For folders that have
    one writer, which repeats what it wrote: a run's, or a micro-batch's."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(table)

"""Compaction of the tables that streams append to.

A stream adds a file per task, day and micro-batch. Compaction writes the rows of a day again
as few files, below `<table>/_compacted`, and names them as the day's current ones together
with the time of the last micro-batch in them (`loaded_at`, the same for all its rows). The
stream's own files and its log stay as they are, so the stream and those that read from it go
on. Readers take the compacted days, and of the stream's files the other days and what has
been modified since: a late tick is read from where the stream has put it.
"""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from marketpulse.sinks import pointers, read_days, replace_days

ASIDE = "_compacted"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _bounds(spark, path):
    """{day: microseconds of the last micro-batch that its compacted files hold}"""
    now = pointers.current(spark, f"{path}/{ASIDE}")
    return {day: int(version.rpartition("-")[2]) for day, version in now.items() if "-" in version}


def _newer(rows, bounds, day_column):
    """The rows that the compacted days do not hold."""
    if not bounds:
        return rows
    known = F.create_map(*(F.lit(x) for day, bound in bounds.items() for x in (day, bound)))
    bound = known[F.col(day_column).cast("string")]
    return rows.where(bound.isNull() | (F.unix_micros("loaded_at") > bound))


def _appended(spark, path, schema, day_column, since=None):
    """The stream's files, or those modified since a time in microseconds."""
    reader = spark.read.schema(schema)
    if since is not None:
        at = datetime.fromtimestamp(since // 10**6, timezone.utc)
        reader = reader.option("modifiedAfter", f"{at:%Y-%m-%dT%H:%M:%S}").option("timeZone", "UTC")
    return reader.parquet(path)


def read_compacted(spark, path, schema, day_column, since=None, until=None):
    """All rows of a table that a stream appends to, each once, or those of the days from
    `since` to `until`."""
    def wanted(rows):
        if since is not None:
            rows = rows.where(F.col(day_column) >= F.lit(str(since)).cast("date"))
        return rows if until is None else rows.where(F.col(day_column) <= F.lit(str(until)).cast("date"))

    bounds = _bounds(spark, path)
    own = wanted(_appended(spark, path, schema, day_column))
    if not bounds:
        return own
    days = [d for d in bounds if (since is None or d >= str(since)) and (until is None or d <= str(until))]
    held = read_days(spark, f"{path}/{ASIDE}", schema, day_column, days=days)
    closed = [F.lit(d).cast("date") for d in bounds]
    others = own.where(~F.col(day_column).isin(closed))
    late = wanted(_appended(spark, path, schema, day_column, min(bounds.values())))
    late = _newer(late.where(F.col(day_column).isin(closed)), bounds, day_column)
    columns = schema.fieldNames()
    return held.select(columns).unionAll(others.select(columns)).unionAll(late.select(columns))


def compact_days(spark, path, schema, day_column, before=None):
    """Compact the days before `before` (all without it) that have rows which their compacted
    files lack; gives these days. The stream may run meanwhile: what it adds after this has
    looked is left to the next time."""
    bounds = _bounds(spark, path)
    new = _newer(_appended(spark, path, schema, day_column), bounds, day_column)
    if before is not None:
        new = new.where(F.col(day_column) < F.lit(str(before)).cast("date"))
    last = new.groupBy(day_column).agg(F.max(F.unix_micros("loaded_at")).alias("bound")).collect()  # one per day
    notes = {str(row[day_column]): row.bound for row in last}
    if notes:
        upto = F.create_map(*(F.lit(x) for day, bound in notes.items() for x in (day, bound)))
        rows = read_compacted(spark, path, schema, day_column)
        rows = rows.where(F.unix_micros("loaded_at") <= upto[F.col(day_column).cast("string")])
        rows = rows.hint("rebalance", day_column)  # few files per day
        replace_days(rows, f"{path}/{ASIDE}", list(notes), day_column, notes=notes)
    return sorted(notes)

"""Day scans over the layer tables."""

from pyspark.sql import functions as F


def scan_day(table, day_column, day, **equal):
    """Rows of one day. With a table partitioned by the day only that folder is read."""
    rows = table.where(F.col(day_column) == F.lit(day).cast("date"))
    for column, value in equal.items():
        rows = rows.where(F.col(column) == value)
    return rows

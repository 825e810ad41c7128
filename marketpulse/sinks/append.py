"""The tables that keep what every run has landed."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from marketpulse.sinks.daily import replace_folders

SHREDDING = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTED_BY = 64  # tasks that list folders


@contextmanager
def settings(spark, values):
    """The session's settings changed for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shredded(spark):
    """VARIANT columns are written with a parquet column for each field that many values have."""
    return settings(spark, dict.fromkeys(SHREDDING, "true"))


def read_folders(spark, schema, table, paths):
    """Some folders of a table, thousands of them at once: without the setting each one is
    listed by a task of its own."""
    with settings(spark, {LISTING: str(LISTED_BY)}):
        return spark.read.schema(schema).option("basePath", table).parquet(*paths)


def land_bronze(rows, path, run_id):
    """Fetched rows below fetch_date=, source= and run_id= folders, their JSON parsed once and
    kept as VARIANT; text that is no JSON stays text. A repeat of the run overwrites what it
    wrote before."""
    record = F.try_parse_json("raw_data")
    rows = rows.withColumns({
        "record": record, "raw_data": F.when(record.isNull(), F.col("raw_data")), "run_id": F.lit(run_id),
    })
    with shredded(rows.sparkSession):
        replace_folders(rows, path, "fetch_date", "source", "run_id")


def land_quarantine(rows, path, run_id, day):
    """Texts that could not be parsed, below run_date= and run_id= folders."""
    marked = rows.withColumns({"run_date": F.lit(day), "run_id": F.lit(run_id)})
    replace_folders(marked, path, "run_date", "run_id")

"""What a run fetched and loaded."""

from pyspark.sql import functions as F

from marketpulse.schemas import RUN_AUDIT


def append_audit(spark, path, run_id, dag_id, execution_date, fetched, loaded, status,
                 started_at, completed_at):
    """Add one measured run."""
    row = (run_id, dag_id, execution_date, fetched, loaded, status, started_at, completed_at)
    cells = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, RUN_AUDIT.fields)]
    spark.range(1).coalesce(1).select(*cells).write.mode("append").parquet(path)


def audit_by_day(fetched, loaded):
    """Rows fetched (bronze) and loaded (silver) per run date, in one aggregation."""
    both = fetched.select(F.col("fetch_date").alias("run_date"), F.lit(0).alias("kept")).unionByName(
        loaded.select("run_date", F.lit(1).alias("kept"))
    )
    return both.groupBy("run_date").agg(
        F.count(F.when(F.col("kept") == 0, 1)).alias("records_fetched"),
        F.count(F.when(F.col("kept") == 1, 1)).alias("records_loaded"),
    )

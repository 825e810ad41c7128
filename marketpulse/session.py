"""Local session for tests and the bench. On a cluster the caller brings its own session."""

from pyspark.sql import SparkSession


def local_session(cores=8, shuffle_partitions=8, memory="8g", **extra):
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marketpulse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

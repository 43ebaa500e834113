"""Session settings the job is meant to run with. Operators never depend on them."""

from pyspark.sql import SparkSession


def build_session(app: str = "tradewind", master: str | None = None, shuffle_partitions: int | None = None, **extra) -> SparkSession:
    """AQE sizes and splits shuffle partitions; ``shuffle_partitions`` is only their upper start value."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **extra,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

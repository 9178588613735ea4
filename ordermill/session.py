"""Session factory for jobs and notebooks."""

from pyspark.sql import SparkSession


def build(app_name: str = "ordermill", **options: str) -> SparkSession:
    """A session in UTC with adaptive execution that removes old checkpoints; ``options`` are extra Spark settings.

    No operator depends on these settings: parsing and casting give the same result under any
    ANSI mode, parser policy or time zone.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in options.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()

"""Session settings the library is tuned for; a cluster's own settings take precedence."""

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("devpulse")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small data: keep all cores busy after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )

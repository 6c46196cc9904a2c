"""SparkSession construction with the settings the operators assume."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every operator relies on: dates are cast in UTC, ANSI arithmetic
# (errors instead of silent overflow), adaptive execution for runtime
# re-planning (partition coalescing, skew-join splitting, join demotion).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Reliable checkpoints (distributed ranking) are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app_name: str = "cartwheel",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with :data:`DEFAULT_CONF` applied.

    ``master`` and ``shuffle_partitions`` are only set when given, so on a
    cluster the submitter's values win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Session-level SQL settings also apply when the session already existed.
    for key, value in settings.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Single-JVM session for tests and the local benchmark."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return get_session(
        master=f"local[{cores}]",
        shuffle_partitions=shuffle_partitions or cores,
        conf={"spark.driver.memory": os.environ.get("CARTWHEEL_DRIVER_MEMORY", "16g")},
    )


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle parallelism: the default fan-out of our own exchanges."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

"""Session settings the warehouse relies on.

The library never creates a session behind a caller's back; ``configure``
only sets the SQL options that the cleaning and query semantics depend on,
and ``get_session`` is a convenience for tests, the bench and scripts.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Options that change results or plans; applied to any session we are handed.
SQL_CONF = {
    # Dates are parsed and emitted in UTC so results do not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    # AQE re-plans joins from runtime sizes (broadcast only when the measured
    # side is under the threshold), coalesces small shuffle partitions and
    # splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SQL_CONF`` to the caller's session; this changes its time zone to UTC for all that follows."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "laborstar") -> SparkSession:
    """Build (or reuse) a session.

    Master and sizing come from the configuration (``spark-submit`` options,
    ``spark-defaults.conf``); without any, Spark starts ``local[*]``. The
    arguments override them (tests, bench). Only the semantic SQL options of
    ``SQL_CONF`` are always applied.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = (builder.master(master).config("spark.ui.showConsoleProgress", "false")
                   .config("spark.driver.memory", os.environ.get("LABORSTAR_DRIVER_MEMORY", "8g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)

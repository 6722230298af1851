"""Session defaults for jobs that bring no session of their own."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution sizes shuffles at run time, splits skewed join
    # partitions and switches to a broadcast join once a side is measured small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the defaults above; ``conf`` overrides them.

    The master and the sizes of the cluster come from spark-submit; ``master``
    is for tests and the bench.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

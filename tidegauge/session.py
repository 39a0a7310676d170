"""SparkSession factory with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "tidegauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE. ``master`` is left to spark-submit where it is None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

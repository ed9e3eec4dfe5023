"""Session settings. A cluster session keeps its own values; these are defaults for local runs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "bazaarlens") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.memory", os.environ.get("BAZAARLENS_DRIVER_MEMORY", "8g"))
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false")
        )
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )

"""Session defaults. Every operator also works on a session made elsewhere."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "sieveframe", **config: str) -> SparkSession:
    """A session with the settings this library is designed for.

    AQE decides join sides from measured sizes, splits skewed join partitions
    and merges small shuffle partitions. It never splits a partition of an
    aggregate, so on a cluster pass ``spark.sql.shuffle.partitions`` as shuffled
    bytes / 128 MB or more and let AQE merge what is too many.
    """
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
        # The JVM does not compile longer methods; looking at every column of a
        # wide file would run interpreted in one generated method.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    builder = SparkSession.builder.appName(name)
    for key, value in {**defaults, **config}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

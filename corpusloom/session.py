"""A session for local runs and tests; on a cluster the caller's session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
    } | ({"spark.checkpoint.dir": shared} if shared else {})
    spark = SparkSession.builder.master(f"local[{cores}]").appName("corpusloom").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

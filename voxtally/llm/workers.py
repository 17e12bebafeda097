"""What Python workers need before they take whole texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from voxtally.session import ship_package

BATCH_CONF, SPARK_DEFAULT, TEXT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ready(spark: SparkSession) -> None:
    """Ship the package, and let Arrow batches hold 1000 texts where the session keeps Spark's 10,000 rows.

    A batch is held whole on both sides of the pipe; results do not depend on it.
    """
    ship_package(spark)
    if spark.conf.get(BATCH_CONF, SPARK_DEFAULT) == SPARK_DEFAULT:
        spark.conf.set(BATCH_CONF, TEXT_ROWS)

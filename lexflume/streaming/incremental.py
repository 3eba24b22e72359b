"""Conversion as files arrive: a file stream through the same expressions that batch uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def convert_arriving(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, convert: Callable[[DataFrame], DataFrame], files: int = 1000) -> StreamingQuery:
    """Starts a query that converts what is in the Parquet files of source, then stops. It may be started again: files
    that were read are not read again. Each batch overwrites its own folder target/batch=<n>, so that one that is run
    twice after a failure leaves its rows once."""

    def write(rows: DataFrame, n: int) -> None:
        convert(rows).write.mode("overwrite").parquet(f"{target}/batch={n}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

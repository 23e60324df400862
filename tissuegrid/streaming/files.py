"""File streams of pixel tables.

Patch statistics and label sums are additive per patch, so the batch operators take a stream unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def pixel_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def write_complete(result: DataFrame, path: str, checkpoint: str):
    """Keep the newest complete result of a grouped stream in a table folder, batch by batch."""
    def save(batch: DataFrame, _number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (
        result.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(save).start()
    )

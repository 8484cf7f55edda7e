"""Row checks over a file stream (Structured Streaming + foreachBatch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislekit.operators.checks import row_check_counts


def stream_row_checks(spark: SparkSession, source_dir: str, schema, table: str, sink_dir: str,
                      checkpoint_dir: str, params: dict | None = None, fmt: str = "parquet",
                      available_now: bool = True):
    """Count violations of every row check of ``table`` in each micro-batch
    of files arriving under ``source_dir``; append (batch_id, check_name,
    checked, failed) to parquet under ``sink_dir``.  Returns the started
    query (``awaitTermination`` it for an available-now run)."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = row_check_counts(batch, table, params).withColumn("batch_id", F.lit(batch_id))
        counts.write.mode("append").parquet(sink_dir)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

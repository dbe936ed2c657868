"""Incremental landing as a stream: the checkpoint is the progress record."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tesora.config import LakeConfig, RunContext, TableSpec
from tesora.sources.bronze import with_technical_columns


def stream_bronze(
    spark: SparkSession,
    spec: TableSpec,
    cfg: LakeConfig,
    run: RunContext,
    landing: str,
    out: str,
    checkpoint: str,
    schema: str | None = None,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Take files not seen before into bronze, once, and stop when there are none left.

    Files lie in the date folders of the run, as batches do, so that reading prunes them alike.
    """
    arrivals = (
        spark.readStream.schema(schema or spec.ddl).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    )
    day = {"year": f"{run.as_of:%Y}", "month": f"{run.as_of:%m}", "day": f"{run.as_of:%d}"}
    return (
        with_technical_columns(arrivals, cfg.source_system, run)
        .withColumns({name: F.lit(value) for name, value in day.items()})
        .writeStream.format("parquet")
        .partitionBy(*day)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

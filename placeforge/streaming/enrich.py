"""Attempts arrive as files; each micro-batch is upserted into the ledger's buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from placeforge.sources.state import upsert_buckets


def enrich_stream(spark: SparkSession, source: str, schema: StructType, base: str, checkpoint: str, to_attempts, key: str = "entity_id", order: tuple[str, ...] = ("ts",), files: int = 1, buckets: int = 64) -> None:
    """Reads what is there and ends. to_attempts maps the raw batch to rows (key, status, attempts, .., order columns), which T1 applies to the
    buckets of the ledger that they touch; a batch that is given twice does no harm, as each starts from the map below its own number."""

    def upsert(batch: DataFrame, number: int) -> None:
        upsert_buckets(to_attempts(batch), base, number, key, order, buckets)

    query = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(upsert).start()
    query.awaitTermination()

"""Incremental jobs with Structured Streaming: an idempotent store merge and a resumable, complete-only ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.store import read_store, replace_buckets


def merge_store(store: DataFrame, batch: DataFrame, today: str, days: int = 90) -> DataFrame:
    """The store after a batch: rows of sources in the batch are replaced where the slot is stated again and kept otherwise; others stay
    (an absent source withdraws nothing); rows older than `days` go. Applying the same batch again changes nothing."""
    fresh = batch.groupBy("slot_hash").agg(F.min_by(F.struct(*[c for c in batch.columns if c != "slot_hash"]), "row_ord").alias("r")).select("slot_hash", "r.*")
    kept = store.join(fresh.select("slot_hash"), "slot_hash", "left_anti")
    merged = kept.unionByName(fresh, allowMissingColumns=True)
    floor = F.date_sub(F.lit(today).cast("date"), days).cast("timestamp_ntz")
    return merged.where(F.col("ts_local").isNull() | (F.col("ts_local") >= floor))


#: Buckets of a store by slot hash; a batch rewrites those that it touches.
BUCKETS = 64


def merge_into(spark: SparkSession, batch: DataFrame, store: str, today: str, days: int = 90, buckets: int = BUCKETS) -> None:
    """Merge a batch into a store on disk. Only the buckets of the batch's slots are read and written anew, and one rename shows them."""
    placed = lambda d: d.withColumn("bucket", F.pmod(F.xxhash64("slot_hash"), F.lit(buckets)).cast("int"))
    touched = sorted(r.bucket for r in placed(batch.select("slot_hash")).select("bucket").distinct().collect())  # at most `buckets`
    if touched:
        now = read_store(spark, store, only=touched)
        replace_buckets(placed(merge_store(batch.limit(0) if now is None else now, batch, today, days)), store, touched)


def run_merge(spark: SparkSession, source: str, schema: str, store: str, checkpoint: str, today: str, files_per_trigger: int = 10):
    """Stream every new file under `source` into the store; the checkpoint makes it resumable, availableNow makes it a bounded run."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    return stream.writeStream.foreachBatch(lambda batch, _: merge_into(spark, batch, store, today)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

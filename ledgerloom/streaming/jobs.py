"""Incremental registry append and scrape-log monitor."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ledgerloom.operators.ordered import keep_first


def append_new_records(spark: SparkSession, source, target, checkpoint, schema, key="record_key", order="src_ordinal", buckets=64) -> None:
    """Append arriving files to ``target``, each record key once, across batches and restarts."""
    stream = spark.readStream.schema(schema).parquet(source)
    write = lambda batch, batch_id: append_batch(batch, batch_id, target, key, order, buckets)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_batch(batch: DataFrame, batch_id: int, target, key="record_key", order="src_ordinal", buckets=64) -> None:
    """Append the rows of a batch whose key is in no other batch of the target, the first of each key.

    The target is partitioned by batch and by a hash bucket of the key; only the buckets that the batch
    touches are read. A batch that comes again, after a failure or with a new checkpoint, replaces its own
    folder and meets all others, so no key is doubled. Batches without rows write nothing.
    """
    spark = batch.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(target))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    touched = [r.bucket for r in batch.select(bucket).distinct().collect()]  # ``buckets`` numbers at most
    schema = StructType([StructField(key, batch.schema[key].dataType), StructField("batch", LongType()), StructField("bucket", IntegerType())])
    seen = spark.read.schema(schema).option("basePath", str(target)).parquet(str(target)).filter((F.col("batch") != batch_id) & F.col("bucket").isin(touched))
    fresh = keep_first(batch, key, order).select("*", bucket).join(seen.select("bucket", key), ["bucket", key], "left_anti")
    fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/batch={batch_id}")


def monitor(rounds: DataFrame, key="event_type", at="ts", width="1 day", late="1 hour") -> DataFrame:
    """Rounds, new rows and mean seconds per key and time bucket; works on streams and tables."""
    marked = rounds.withWatermark(at, late) if rounds.isStreaming else rounds
    return marked.groupBy(F.window(at, width), key).agg(
        F.count("*").alias("rounds"), F.sum("new_rows").alias("new_rows"), F.round(F.avg("seconds"), 4).alias("mean_seconds"),
    ).select(F.col("window.start").alias("bucket_start"), key, "rounds", "new_rows", "mean_seconds")

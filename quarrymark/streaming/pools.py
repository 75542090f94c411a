"""Incremental variants: pools that grow, windows over events, and sinks that append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import own_folder


def stream_json(spark: SparkSession, path: str, kind: str, per_trigger: int = 100) -> DataFrame:
    """JSON lines dropped in a folder; the checkpoint remembers what was read."""
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", per_trigger).json(path)


def distinct_within(stream: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def counts(stream: DataFrame, ts: str, window: str = "60 seconds", slide: str | None = None, late: str = "10 minutes", *keys: str) -> DataFrame:
    own = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return own.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sessions(stream: DataFrame, key: str, ts: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    own = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return own.groupBy(F.session_window(ts, gap).alias("s"), key).agg(F.count("*").alias("n")).select(F.col("s.start").alias("start"), key, "n")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch as Parquet until what is there is done; a batch that comes again overwrites its own folder."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(spark: SparkSession, stream: DataFrame, mode: str, path: str | None = None) -> DataFrame:
    """Run a stream over what is there now into Parquet: each batch is a folder, and in complete mode the last one counts.

    path: a folder of the run's own; below spark.checkpoint.dir (locally, where that is unset, a temporary one) where it is None. No row
    passes through the driver.
    """
    base = path or own_folder(spark, "stream")

    def save(batch: DataFrame, number: int) -> None:
        folder = f"{base}/rows" if mode == "complete" else f"{base}/rows/batch={number}"
        batch.write.mode("overwrite").parquet(folder)

    stream.writeStream.foreachBatch(save).outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/rows")):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{base}/rows").select(*stream.columns)

"""I4: transaction ingest as a Structured Streaming query.

A file source (new parquet/json batches dropped in a folder) feeds
``foreachBatch``. Every file is a batch of its own: it is validated like an
HTTP batch (I2) and written whole (I3) or sent whole to a quarantine folder,
whatever else arrived in the same trigger. The checks of all files of a trigger
run together, grouped by ``_metadata.file_path``; nothing loops over files.

A batch's id is its file's name without endings. Its rows go to
``batch_id=<id>/``, which a later delivery replaces: an epoch that is replayed
after a failure, a file that is submitted again under another path, and a
corrected file all end up counted once. Of several files with one id in a
trigger the newest counts (by modification time, then path). A batch that turns
out bad on resubmission goes to quarantine and leaves the good rows in place.
The checkpoint (offsets + commit log) lives in the shared checkpoint folder.
With ``Trigger.AvailableNow`` the query drains the backlog and stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopframe.operators.ingest import validate_files
from shopframe.session import checkpoint_dir

BATCH_SCHEMA = T.StructType([
    T.StructField("t_dat", T.DateType()), T.StructField("customer_id", T.LongType()),
    T.StructField("article_id", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("sales_channel_id", T.IntegerType())])


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def batch_of(file: str | Column) -> Column:
    """The batch id of a path: its last part up to the first ending (leading dots left out)."""
    return F.regexp_extract(F.substring_index(F.col(file) if isinstance(file, str) else file, "/", -1), r"^\.*([^.]+)", 1)


def ingest_files(batch: DataFrame, epoch_id: int, target: str, quarantine: str, customers: DataFrame, articles: DataFrame) -> None:
    """One trigger: rows with ``_file`` and ``_time``; good files to ``target``, others to ``quarantine``.

    The reports have a row per file of the trigger, at most ``max_files``, and
    are broadcast. Ids are taken from files, not from rows.
    """
    batch = batch.persist()
    try:
        files = batch.groupBy("_file").agg(F.max("_time").alias("_time")).withColumn("batch_id", batch_of("_file"))
        newest = files.groupBy("batch_id").agg(F.max(F.struct("_time", "_file")).alias("_m")).select("batch_id", F.col("_m._file").alias("_file"))
        rows = batch.join(F.broadcast(newest), "_file")
        report = F.broadcast(validate_files(rows, customers, articles, "_file").select("_file", "ok"))
        judged = rows.join(report, "_file").withColumn("batch_epoch", F.lit(epoch_id).cast("long")).drop("_file", "_time")
        _write(judged.where("ok").drop("ok"), target)
        bad = judged.where("NOT ok").drop("ok")
        if not bad.isEmpty():
            _write(bad, quarantine)
    finally:
        batch.unpersist()


def stream_transactions(spark: SparkSession, source: str, target: str, quarantine: str, customers: DataFrame,
                        articles: DataFrame, name: str = "ingest", fmt: str = "parquet",
                        available_now: bool = True, max_files: int = 100):
    """Start the ingest stream; returns the ``StreamingQuery``."""
    ckpt = f"{checkpoint_dir(spark)}/streams/{name}"
    src = spark.readStream.schema(BATCH_SCHEMA).option("maxFilesPerTrigger", max_files).format(fmt).load(source)
    src = src.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_time"))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        ingest_files(batch, epoch_id, target, quarantine, customers, articles)

    w = src.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def windowed_sales(stream: DataFrame, watermark: str = "2 days", window: str = "1 day") -> DataFrame:
    """Streaming revenue per day and channel with a watermark for late batches (event time = t_dat)."""
    ts = F.col("t_dat").cast("timestamp")  # watermarks need TIMESTAMP
    return stream.withColumn("_ts", ts).withWatermark("_ts", watermark) \
        .groupBy(F.window("_ts", window), "sales_channel_id") \
        .agg(F.count(F.lit(1)).alias("n_transactions"), F.sum("price").alias("revenue"))

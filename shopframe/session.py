"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults tuned for wide fact tables: AQE re-plans joins and coalesces
# partitions at runtime, skew-join splitting handles hot keys, and the UI is
# off because nothing here serves pages.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of DataFrames that went out of scope are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # partition sizing: AQE coalesces shuffle output towards 128 MB per task,
    # scans split files at 256 MB, a partition 5x the median and above 256 MB
    # counts as skewed and is split for joins
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
}


def build_session(master: str | None = "local[8]", app: str = "shopframe",
                  shuffle_partitions: int | None = 8,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB), or leave it to AQE coalescing.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one. A local session
    without it gets a private temporary folder; a cluster session without it is
    an error, since its machines share no local folder.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        d = tempfile.mkdtemp(prefix="shopframe-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that is planned here are removed when it ends.

    Otherwise they stay until the driver happens to collect its garbage, so that
    those of many stored steps add up on the executors' disks.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df):
    """Cut the lineage of an intermediate result with a reliable checkpoint.

    Written to the shared checkpoint folder, so it survives the loss of the
    executors that computed it (unlike ``localCheckpoint``). Used between the
    passes of multi-pass operators (itemset levels) so later passes plan and
    run against a small stored table instead of re-planning the whole input.
    Its shuffle files go as soon as it is written.
    """
    checkpoint_dir(df.sparkSession)
    with swept(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a frame is planned when it is made


class Work:
    """Intermediate tables of one operator run, in the cluster's shared folder.

    ``store`` writes a frame as Parquet and rereads it: the lineage is cut, and
    the rows survive the loss of the executors that made them. Its shuffle files
    go as soon as it is written. ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        with swept(self.spark):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)

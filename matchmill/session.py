"""Session set-up and staged tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "matchmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; explicit ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split hot join partitions even if that costs a later shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see.

    It is the one the session names in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of its own, as in tests.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # a local cluster has executors of its own
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="matchmill-")
    spark.conf.set(CHECKPOINT_DIR, path)
    return path


def app_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one."""
    return f"{shared_dir(spark)}/{spark.conf.get('spark.app.id', 'matchmill')}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a later step must see exactly the same rows twice (partition numbers, a table that is
    read and replaced): the copy survives lost executors and cuts the lineage. All copies of an
    application lie in one folder named after it, which may be removed once the application has ended.
    """
    spark = df.sparkSession
    path = f"{app_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    copy._staged_at = path
    return copy


def drop_stage(copy: DataFrame) -> None:
    """Remove what ``stage`` returned, once nothing will read it again: tables made from it must have been written already."""
    spark = copy.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(copy._staged_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

"""Session settings and the shared scratch folder."""

import uuid

from pyspark.sql import SparkSession

# Settings a job should run with.  AQE sizes shuffle partitions at run time and
# splits partitions that one hot join key has made too large.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a lookup may take on each executor: before the run by its files, during the run as measured.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot leaves methods above 8000 bytes of bytecode interpreted; a projection of 46 parsed
    # fields is larger, and runs three times as fast when Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app="civicmill", **conf):
    """A session with the settings above; the master comes from spark-submit or ``conf``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark):
    """The folder that all executors see, for checkpoints and intermediate tables.

    It is the one named by ``spark.checkpoint.dir``, which every session has to set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark, label):
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/civicmill/{label}-{uuid.uuid4().hex}"


def cut(df):
    """Reliable checkpoint: later steps restart from files, not from the whole lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def remove_path(spark, path):
    """Delete a file or folder, in whatever store it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

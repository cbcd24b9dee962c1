"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a fresh session gets. AQE does the run-time sizing: it coalesces small shuffle partitions and splits the
# skewed side of a sort-merge join, so neither has to be hand-tuned per table.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a checked dataset has two outcome folders: keep a writer open for each instead of sorting the rows first
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.ui.enabled": "false",
}
LOCAL_SHUFFLE_PARTITIONS = "8"


def get_spark(app_name: str = "trustlake", master: str | None = None, **conf: str) -> SparkSession:
    """Return the running session untouched, or start one (on local cores unless the launcher named a master)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if master is not None and master.startswith("local"):
        settings["spark.sql.shuffle.partitions"] = LOCAL_SHUFFLE_PARTITIONS
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SCRATCH = "trustlake.scratch.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session (tests, a laptop) may fall back to a temporary folder, because there driver and executors are
    the same machine. Reads the session's settings only, so that it works on any kind of session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if configured is None:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("Set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="trustlake-")
        spark.conf.set(SCRATCH, configured)
    return configured.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, inside the shared folder.

    All paths of one application lie in one folder, which may be removed when the application has ended.
    """
    application = spark.conf.get("spark.app.id", "application")
    return f"{shared_dir(spark)}/trustlake/{application}/{label}-{uuid.uuid4().hex[:12]}"


def lineage_cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later jobs start there even if executors are lost.

    A columnar table rather than an RDD checkpoint: later readers prune its columns, and its true size is known when
    they choose a join.
    """
    path = work_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

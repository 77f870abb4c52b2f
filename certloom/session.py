"""Session helpers: the configuration every job in this package expects."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL confs the plans rely on.  They are runtime-settable, so they are applied
# to whatever session the caller hands in (the driver builds its own).
PLAN_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_plan_confs(spark: SparkSession) -> SparkSession:
    for key, value in PLAN_CONFS.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "certloom", conf: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests, bench and examples (never used on a cluster,
    where the cluster's own session is passed in)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_plan_confs(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is always honoured.
    Only a ``local`` master without it gets a fresh scratch folder; elsewhere
    a machine-local folder would lose data, so it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="certloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def store(df: DataFrame, name: str = "stored", buckets: int | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder, as compressed columns, and read it back: readers take
    only the columns they need, and nothing upstream runs again.  ``buckets``: bucketed by document, so that readers
    that group by document shuffle nothing; rows that are partitioned so already are not shuffled here either."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{run}"
    if buckets:
        (df.repartition(buckets, "doc_id").write.option("compression", "zstd").option("path", path)
         .bucketBy(buckets, "doc_id").saveAsTable(f"certloom_{name}_{run}"))
        return spark.table(f"certloom_{name}_{run}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the engine should carry.  The shuffle partition
# count is a ceiling: AQE coalesces small partitions at runtime and splits
# skewed ones in joins.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # No broadcast from planning-time estimates (file sizes say little about
    # a side's size in memory).  Broadcasts are either of rows held in the plan
    # (plans/joins.py), or chosen by AQE from the measured size of a finished
    # shuffle stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(
    master: str | None = None,
    app_name: str = "tollgate",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the engine settings.  On a cluster leave ``master``
    unset (spark-submit decides) and size ``shuffle_partitions`` to the data,
    about input bytes / 128 MB for the largest shuffle."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(ENGINE_CONF)
    if master and master.startswith("local"):
        settings["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in a local session that names none (tests) a private folder is
    created and registered as the checkpoint directory.  On a cluster a
    machine-local folder would lose what other executors write, so a missing
    setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            base = current
        else:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError(f"spark.checkpoint.dir is not set: a {master} session needs a shared folder there")
            base = tempfile.mkdtemp(prefix="tollgate-ckpt-")
            spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared directory."""
    return f"{shared_dir(spark)}/tollgate/{name}-{uuid.uuid4().hex}"

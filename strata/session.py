"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a layered batch job wants at any scale: adaptive re-planning (partition
# coalescing, skew-join splitting, runtime broadcast demotion), UTC wall clock,
# and Arrow for the rare pandas hand-off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`DEFAULT_CONF` applied.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; locally
    pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there and it is used as is.
    Only when the setting is absent -- local runs and tests -- a fresh local
    folder is created and registered.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not cur:
        cur = sc.getCheckpointDir()           # set through sc.setCheckpointDir(...)
    if not cur:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a "
                               "shared folder (HDFS, object store); a machine-local folder "
                               "would not survive the loss of an executor")
        cur = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """Within, the session's setting has the value (None: as it is)."""
    if value is None:
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Bytes of a file and, as shuffled, of a shuffle that a small task is given.
SPLIT_BYTES = 32 * 1024 * 1024
SHARE_BYTES = 16 * 1024 * 1024
#: Parts, at least, that a shuffle's rows are dealt into before AQE puts parts together.
PARTS = 200


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Within, more input makes more tasks and not larger ones: hash tables and
    sorts of a task stay in its memory. For jobs whose grouping holds many keys;
    a table's files are written apart, in their own size."""
    parts = max(PARTS, int(spark.conf.get("spark.sql.shuffle.partitions", str(PARTS))))
    with (setting(spark, "spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES)),
          setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHARE_BYTES)),
          setting(spark, "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))):
        yield


def materialize(df, name: str = "materialized"):
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back.

    One job computes ``df`` once (an eager ``checkpoint()`` computes it a
    second time to write it); the result is columnar, so later reads prune
    columns. Survives executor loss: the files live in the shared folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

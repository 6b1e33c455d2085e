"""Session construction and the shared scratch folder.

Everything session-wide the operators rely on lives here: UTC session time
zone (day windows align to the epoch in UTC), AQE with skew-join splitting,
Arrow for the few pandas paths, and the RocksDB state store that
``transformWithState`` needs.  Library functions never create a session;
they take the caller's.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def build_session(master: str | None = None, app: str = "eventlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  scratch: str | None = None) -> SparkSession:
    """Builder used by tests, bench and scripts.  On a cluster the
    submitter's settings win; only unset keys get our defaults.  ``scratch``
    is the shared folder for intermediate tables; a local master may leave it
    out and gets a temporary one."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # checkpoint files of the ordered scans are removed once unreferenced
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
        scratch = scratch or tempfile.mkdtemp(prefix="eventlens-ckpt-")
    if scratch:
        conf["spark.checkpoint.dir"] = scratch
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    apply_sql_defaults(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Pin the runtime SQL settings results depend on (time zone, ANSI) and
    the state store ``transformWithState`` needs, on any caller's session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def own_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, with the same settings but for those
    results depend on: the caller's session keeps its own."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and own.conf.isModifiable(k):
            own.conf.set(k, v)
    apply_sql_defaults(own)
    return own


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Lineage cuts, streaming checkpoints and materialised tables go below it.
    When it is unset we create one only in local mode (tests); on a cluster a
    machine-local folder would be wrong, so we refuse.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            root = os.path.dirname(current.rstrip("/"))
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        root = tempfile.mkdtemp(prefix="eventlens-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused folder below the shared root."""
    return f"{scratch_root(spark)}/eventlens/{kind}/{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path, as Hadoop objects."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where

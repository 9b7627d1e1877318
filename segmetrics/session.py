"""Session helpers: a tuned local session for tests/bench and the
checkpoint folder taken from the cluster configuration."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ZONE = "Asia/Seoul"          # of the daily schedule


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "segmetrics", driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", ZONE)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(configured: str | None, master: str) -> str:
    """The folder the cluster names; a fresh local one only for a local master."""
    if configured:
        return configured
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="segmetrics-ckpt-")


def _root(spark: SparkSession) -> str:
    """``checkpoint_root`` of the session, the same for its whole life."""
    sc = spark.sparkContext
    if not hasattr(sc, "_checkpoint_root"):
        sc._checkpoint_root = checkpoint_root(spark.conf.get("spark.checkpoint.dir", None), sc.master)
    return sc._checkpoint_root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set the checkpoint folder once per session: the one the cluster names in
    ``spark.checkpoint.dir``; only for a local master without one (tests, a
    laptop) a fresh local folder is made, on a cluster that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None or getattr(sc, "_own_checkpoints_over", False):
        sc.setCheckpointDir(_root(spark))
        sc._own_checkpoints_over = False
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (survives executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder for a table that outlives its job."""
    return f"{_root(spark).rstrip('/')}/table-{uuid.uuid4().hex}"


class own_checkpoints:
    """Checkpoints written in this block go to a folder of their own, which is
    deleted at its end: a scheduled job leaves nothing behind. What the block
    returns must have been written elsewhere by then."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        sc = self.spark.sparkContext
        self.folder = f"{_root(self.spark).rstrip('/')}/run-{uuid.uuid4().hex}"
        sc.setCheckpointDir(self.folder)
        sc._own_checkpoints_over = False
        return self

    def __exit__(self, *_):
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        sc._own_checkpoints_over = True


def cluster_conf(total_cores: int, checkpoint_dir: str) -> dict[str, str]:
    """Settings the plans are designed around on a large cluster.

    * Scans split into ~256 MB tasks; the account scan is the only step that
      grows with the data, and it ends in a partial aggregate.
    * Shuffles start wide (a few tasks per core) and AQE coalesces them to
      ~128 MB, so the small post-aggregation stages do not run thousands of
      empty tasks; AQE also splits skewed join partitions.
    * Broadcasts only below a measured 64 MB; above it the same joins run as
      shuffle joins."""
    return {
        "spark.sql.session.timeZone": ZONE,
        "spark.checkpoint.dir": checkpoint_dir,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }

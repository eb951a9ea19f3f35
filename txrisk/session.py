"""Session settings and reliable materialisation.

Shuffle sizing is the main knob at scale: aim for ~128-256 MB per shuffle partition
and let AQE coalesce small ones and split skewed ones at runtime.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the package relies on. AQE re-plans joins at runtime (broadcast
# only when the measured side is small, split skewed partitions); nothing here forces
# a broadcast of data whose size grows with the input.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, minimum: int = 8) -> int:
    """Shuffle partition count so that each reducer sees about ``target_bytes``."""
    return max(minimum, -(-input_bytes // target_bytes))


def build_session(master: str | None = "local[*]", shuffle_partitions: int = 8, app: str = "txrisk", **extra) -> SparkSession:
    """A session with the package's settings. ``master=None`` keeps the one spark-submit set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({k: str(v) for k, v in extra.items()})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder, setting it from ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the session; only a local
    session (tests, bench) may fall back to a fresh temporary folder. A remote (Connect)
    session has no driver-side context here: the server's configured folder is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: checkpointing is configured on the server
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master == "local" or sc.master.startswith("local["):  # one machine; not local-cluster
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="txrisk-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for reliable checkpoints")
    return sc.getCheckpointDir()


class Workspace:
    """A folder of its own below the checkpoint folder for the kept tables of one run."""

    def __init__(self, spark: SparkSession, tag: str):
        folder = ensure_checkpoint_dir(spark)
        if folder is None:
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for kept tables")
        self.spark, self.path = spark, f"{folder.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
        self.tables = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as parquet and read it back.

        Used for intermediates with several consumers (the customer profile, the alert rows): a
        lost executor then costs a re-read, not a re-scan of the fact table, and each consumer
        reads only its columns.
        """
        self.tables += 1
        path = f"{self.path}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete the folder, wherever the checkpoint folder is (by its own file system)."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Keep one table outside any run; its files stay until the checkpoint folder is cleaned."""
    return Workspace(df.sparkSession, "kept").keep(df)

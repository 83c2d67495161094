"""Session helpers: shared scratch space, lineage cuts, loop state.

Everything that must survive the loss of an executor is written below the
folder the cluster names in ``spark.checkpoint.dir``.  We never fall back to
a machine-local folder on a cluster; only a ``local[...]`` master (tests, the
bench) may get a private temporary folder when the setting is missing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark settings this engine is tuned for.  At cluster scale the caller sizes
# shuffle partitions for the data; AQE then coalesces small partitions and
# splits skewed ones at run time.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "trellis") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master.startswith("local"):
        builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only for local masters."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="trellis-ckpt-"))
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/trellis-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below this application's part of the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove all scratch of this application; for its end, as frames that still read it fail then.

    Spark's own checkpoints lie beside it and follow ``spark.cleaner.referenceTracking.cleanCheckpoints``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the data is written to the shared folder, so a lost
    executor does not force recomputing every earlier round of a loop."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a lineage cut like a checkpoint, whose
    size Spark knows when it chooses joins."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RoundState:
    """Lineage control for loops: ``persist`` every round, reliable checkpoint every
    ``every`` rounds.  A lost executor recomputes at most ``every`` rounds from the
    last checkpoint (every round is deterministic)."""

    def __init__(self, every: int = 4):
        self.every = every
        self.n = 0
        self._held: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        if self.n % self.every == 0:
            out = cut_lineage(df)
            for old in self._held:
                old.unpersist()
            self._held = []
            return out
        out = df.persist()
        self._held.append(out)
        return out


def bounded_count(df: DataFrame, bound: int) -> int:
    """Count rows, but stop reading after ``bound + 1`` of them."""
    return df.limit(bound + 1).count()

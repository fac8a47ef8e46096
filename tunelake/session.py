"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_ROWS = 20_000  # of a word or an id and a few numbers, the most that are broadcast


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tunelake") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, Arrow on."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a shared file system every
    executor sees). Only a local-mode session without it gets a fresh temp
    folder, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tunelake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a written table under the scratch folder that nothing reads any more."""
    base = checkpoint_dir(spark).rstrip("/")
    if not path.startswith(f"{base}/tables/"):
        raise ValueError(f"{path} is not a scratch table")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that no table refers to: it does so when the driver collects garbage,
    which by itself may be long after they were of use."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def if_small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """``df``, evaluated once and marked for broadcast if it has at most ``most`` rows; as it is otherwise.

    The planner sees no size behind joins and aggregates, so it would shuffle what ``df`` is joined with; AQE
    learns the size only when that has happened."""
    head = cut_lineage(df.limit(most + 1))
    return F.broadcast(head) if head.count() <= most else df


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` over ``spark.sql.shuffle.partitions`` tasks, for rows that are small but dear to expand: AQE merges
    shuffled partitions by their bytes, and would leave them to one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)

"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings every job here relies on.  Sizing (executors, shuffle partitions)
# belongs to the cluster and is never overridden.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of code; beyond it the
    # row-wise operators with their small compiled projections are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


_LOCAL_SCRATCH: dict[str, str | None] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Put the runtime settings of :data:`REQUIRED_CONF` on a session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Runtime settings for as long as the block runs."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cores: int | str = "*", app: str = "gablework", partitions: int = 8) -> SparkSession:
    """A session for tests and the local benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only made up on a local master, where driver and
    executors are one process; a cluster without the setting is an error.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        # The setting is fixed once a session runs, so the choice is kept here.
        app = spark.sparkContext.applicationId
        root = _LOCAL_SCRATCH.setdefault(app, None) or tempfile.mkdtemp(prefix="gablework-")
        _LOCAL_SCRATCH[app] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; nothing exists there yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` and its write came to an end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan over all cores when it comes in fewer pieces than that.

    Meant for a file or two on a wide machine.  A large input has more pieces
    than there are cores and is left as it lies, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch area and read it back.

    For plans that pass over a joined input more than once: the join runs a
    single time, later passes read only the columns they need, and the loss of
    an executor costs no recomputation beyond its own tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

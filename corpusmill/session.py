"""Session settings, and the one way intermediate tables are materialised."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; whatever is set already wins.

    Shuffles get four partitions per core of the cluster: enough for partitions to fit in
    memory at any size it can hold, and adaptive execution merges those that turn out small.
    """
    builder = SparkSession.builder.appName(app)
    # what was materialised is deleted when no plan refers to it any more
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(max(4 * spark.sparkContext.defaultParallelism, 8)),
    }
    for key, value in defaults.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Sets the folder of intermediate tables if the session has none yet."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        # A folder of one machine is fine for local runs only: on a cluster the
        # other executors could not read what one of them wrote.
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="corpusmill-")
    sc.setCheckpointDir(configured)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is planned and run within leaves no shuffle files.

    Otherwise they stay on disk until the driver happens to collect its garbage. A plan must not be run
    twice under this setting, as its second run would look for the files of the first.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read it from there on.

    Used for tables which several later jobs read, so that neither a later job nor a
    lost executor has to scan the corpus again. Shuffle files of the job are removed with its end.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with brief_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own, as `df` may be run again


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new place in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4()}.{kind}"


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet to the shared checkpoint folder and read from there."""
    path = shared_path(df.sparkSession, "parquet")
    with brief_shuffles(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.parquet(path)

"""Session building and the shared working folder of a run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow.fs as fs
from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: The folder of this run's tables within the shared one.
RUN = uuid.uuid4().hex[:12]


def build_session(app: str = "specloom", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the engine is tested with."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Only on a local master, where every task is on this machine, may it be unset; a
    temporary folder is then made and set. On a cluster that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(CHECKPOINT_KEY) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="specloom-")
        atexit.register(shutil.rmtree, root.removeprefix("file://"), ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for a written table of one run."""
    return f"{shared_root(spark)}/specloom/{RUN}/{label}-{uuid.uuid4().hex[:12]}"


def cut(df, label: str):
    """Cut the lineage of ``df`` with a written table in the shared folder.

    It stays until ``clear``: a result that is read later, or read again after an executor
    is lost, needs it.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes all tables that this run has written to the shared folder; its results must have been taken."""
    files, base = fs.FileSystem.from_uri(f"{shared_root(spark)}/specloom/{RUN}")
    if files.get_file_info(base).type != fs.FileType.NotFound:
        files.delete_dir(base)

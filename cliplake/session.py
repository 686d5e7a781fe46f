"""Session and lineage helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "cliplake", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the engine expects (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cliplake-")  # on the driver only
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "cliplake_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for base, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)  # served by the driver: the executors need no folder of ours
    _shipped.add(context.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the cluster's ``spark.checkpoint.dir`` if set, else a local one.

    The local fallback is for single-JVM runs and tests only; a cluster names a shared folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), "cliplake-checkpoints")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, keeping partitions and their order."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


_written: list[tuple[SparkSession, str]] = []


def write_out(df: DataFrame) -> DataFrame:
    """``df`` as a table written in the checkpoint folder and read back: fresh statistics, no row order.

    The files stay until :func:`release` or the end of the process, for whatever still reads them.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cliplake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Remove the tables that :func:`write_out` has left."""
    while _written:
        spark, path = _written.pop()
        try:
            context = spark.sparkContext
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone already
            continue


atexit.register(release)


def table_partitions(spark: SparkSession) -> int:
    """The partition count that the session is tuned for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

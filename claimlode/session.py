"""Session helpers: building a session, shipping the package to executors, pinning data."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE_DIR = Path(__file__).resolve().parent


def local_session(cores: int | str = 8, app: str = "claimlode", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (same effect as ``--py-files``), once per context."""
    context = spark.sparkContext
    if getattr(context, "_claimlode_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="claimlode-ship-")) / "claimlode.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(PACKAGE_DIR.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE_DIR.parent))
    context.addPyFile(str(archive))
    context._claimlode_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master with the setting unset.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="claimlode-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder, so a lost executor cannot change its values."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder: computed once, of known size, safe against lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings and the shared folder used to cut lineage or to stage files."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vacantia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on. Shuffle sizes stay with the cluster and AQE."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once for an application, unless their path has it already.

    Functions that run in Python workers are imported there by name. An installed package or a PYTHONPATH that names its folder
    needs nothing; else the driver serves the package as an archive.
    """
    root = Path(__file__).resolve().parent
    named = [Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root.parent in named or root.parent.name == "site-packages" or spark.sparkContext.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="vacantia-")) / "vacantia.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one named by ``spark.checkpoint.dir``. Only a local session, where driver and executors
    are one process, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="vacantia-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def use_checkpoints(spark: SparkSession) -> None:
    """Let long iterative jobs cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: int) -> DataFrame:
    """The rows written to the shared folder and read back: for rows used more than once, and to cut lineage."""
    path = staging_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session construction and the few settings every operator relies on."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "gleaner", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution and Arrow transfer switched on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application; Spark serves the file from the driver."""
    context = spark.sparkContext
    if getattr(context, "_gleaner_shipped", False):
        return
    package = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as at:
        tree = Path(at, "tree", package.name)
        shutil.copytree(package, tree, ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(f"{at}/{package.name}-{uuid.uuid4().hex}", "zip", tree.parent)
        kept = Path(tempfile.mkdtemp(prefix="gleaner-package-"), Path(archive).name)
        shutil.move(archive, kept)
    context.addPyFile(str(kept))
    context._gleaner_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a new local one where that is unset (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="gleaner-")
        spark.sparkContext.setCheckpointDir(at)
    return at


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    at = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(at)


def spread(df: DataFrame, per_core: int = 3) -> DataFrame:
    """Repartition only where the scan has fewer splits than the cores need.

    For stages whose time goes into Python: on large inputs there are more splits than cores
    and nothing is moved. What comes out of a shuffle is left as it is (and not run to be counted).
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = cores * per_core
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)

"""Session helpers shared by tests, bench and queries."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: Bytes of rows that go to a Python worker at once; Spark's default of 64 MB costs several times that for each task.
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of fewer splits than cores, dealt to all cores; other tables stay where they are, so at scale nothing is shuffled for it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def local_session(cpus: int | str = "*", partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session with the settings that tests and the bench share."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sampleprep")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which every executor reaches; only a local session without it gets one of its own."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
    return folder.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application, once; they may run where it isn't installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    made = Path(tempfile.mkdtemp(prefix="sampleprep-")) / "sampleprep_package.zip"
    with zipfile.ZipFile(made, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(made))
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """mapInArrow for functions of this package, with batches that keep long texts from filling an executor."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(function, schema)

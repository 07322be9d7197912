"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "lamina") -> SparkSession:
    """A session for tests and benches; a cluster passes its own instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the star-schema or corpus tables below sf_dir."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores (a single small file) dealt over all cores; larger ones as they are.

    Text work is narrow and would otherwise run in the one task that holds the file's only row group.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def ship(spark: SparkSession) -> SparkSession:
    """spark, once its executors can import this package wherever they run: a zip of it goes along with the session."""
    context = spark.sparkContext
    if getattr(context, "_lamina_shipped", None) is None:
        root = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp(prefix="lamina-zip-")) / "lamina_package.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, Path("lamina") / file.relative_to(root))
        context.addPyFile(str(path))
        context._lamina_shipped = str(path)
    return spark

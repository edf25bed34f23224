"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Settings every job relies on: UTC clock, runtime re-planning, skew joins."""
    ship_package(spark)
    for name, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # keyed state on local disk, with changelog checkpoints in the shared folder
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the shared one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="swipeline-")
    return f"{base.rstrip('/')}/swipeline-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame as a table in the shared folder and go on from there.

    Later reads take only the columns they need, and a lost executor costs no
    more than its current tasks.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings every job here is written for. AQE re-plans joins and partition counts at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.sizeOfNull": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sigilgraph")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as they may start in another folder
    (a cluster gets it through ``--py-files`` or its image)."""
    root, known = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *paths])


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Keep the session's Arrow batches, of whole texts, to so many rows; only jobs whose Python workers read texts ask for it."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def bounded_tasks(spark: SparkSession) -> None:
    """Keep what a task reads of a shuffle to 16 MB and of files to 32 MB, what it reads of one key in a join to 64 MB (a larger partition is split) and
    what the driver broadcasts to 1 MB, by the compressed sizes that Spark plans with: rows of a few numbers take twenty times as much memory in a join or an
    aggregate. Smaller settings of the session stay."""
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20), ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", 64 << 20), ("spark.sql.autoBroadcastJoinThreshold", 1 << 20), ("spark.sql.files.maxPartitionBytes", 32 << 20)):
        now = spark.conf.get(key)
        if not now.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) > most:
            spark.conf.set(key, most)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the cluster, or a temporary
    folder of this machine where the setting is absent and all runs on one machine. Raises RuntimeError if a cluster names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = f"file://{tempfile.gettempdir()}/sigilgraph-work"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that a job writes and reads again."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str, codec: str | None = None):
    """Write ``df`` to the shared folder (packed by ``codec``, or as the session packs) and read it back: lineage is cut, and an executor that is
    lost costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)

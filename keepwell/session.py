"""Session settings and the shared folder for materialised intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return tune(
        SparkSession.builder.master(f"local[{cores}]").appName("keepwell")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def tune(spark: SparkSession) -> SparkSession:
    """Settings the wide account projections need, on any session.

    The JVM never compiles a method of more than 8,000 bytes of code, and one
    generated stage over 38 to 60 columns is larger: it would run interpreted, and
    was measured 3 to 6 times slower. With this limit Spark generates such stages
    in small methods instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="keepwell-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """``df`` stored as a columnar table in the shared checkpoint folder.

    Used where a result is read several times. Like a checkpoint it cuts the
    lineage and survives lost executors, but later passes read only the
    columns they need.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Tables a stage leaves behind for the next one: write, read, presence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGE_TABLES = (
    "features", "churn_model_comparison", "churn_confusion_matrix",
    "churn_contributions", "clv_metrics", "clv_feature_importance",
    "segment_evaluation", "segment_profiles", "customer_segments",
    "priority_matrix",
)
STAGE_MODELS = ("churn_model", "clv_model", "segmentation_model")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_table(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Write and hand back the stored table, so later stages scan files
    instead of repeating the plan that made it."""
    path = table_path(root, name)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return read_table(df.sparkSession, root, name, fmt, df.schema)


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               schema=None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(table_path(root, name))


def publish(spark: SparkSession, root: str, names=STAGE_TABLES) -> list[str]:
    """Register the stage tables as temporary views for SQL users."""
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)
    return list(names)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in the place of another, which goes."""
    old, fs = _file_system(spark, source)
    new, _ = _file_system(spark, target)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it is not there."""
    hadoop_path, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file unless the target is there already."""
    old, fs = _file_system(spark, source)
    new, _ = _file_system(spark, target)
    return not fs.exists(new) and bool(fs.rename(old, new))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, by the driver."""
    hadoop_path, fs = _file_system(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Works for every file system the cluster knows, not only local disk."""
    hadoop_path, fs = _file_system(spark, path)
    return bool(fs.exists(hadoop_path))


def missing_artifacts(spark: SparkSession, root: str,
                      names=STAGE_TABLES + STAGE_MODELS) -> list[str]:
    """Stage outputs that are not there yet; empty once the pipeline has run."""
    return [n for n in names if not path_exists(spark, table_path(root, n))]


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for a report table."""
    return df.select(*[
        F.round(F.col(n), digits).alias(n) if t == "double" else F.col(n)
        for n, t in df.dtypes
    ])

"""The batch scoring function on a stream.

Scoring is stateless: models, names and medians are fixed when a micro-batch
starts. So there is no watermark and no state store; each micro-batch is one
projection whose accepted and rejected records go to a sink each. A stream that
is given a bundle keeps it; one that is given ``CurrentBundle`` asks for the
version in force at the start of every micro-batch and notes it with the rows, so
no batch is scored by two versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keepwell import contract as C
from keepwell.operators.score import OUTPUTS, Bundle, score_records
from keepwell.operators.versions import CurrentBundle

# Parts of a micro-batch per core that are taken as they come.
_PARTS_A_CORE = 4


def account_stream(spark: SparkSession, path: str, schema=C.ACCOUNT_SCHEMA,
                   fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def spread(batch: DataFrame) -> DataFrame:
    """A micro-batch in one task per core at least, all with rows. A file comes in
    about as many parts as there are cores, but these are ranges of bytes, and all rows
    of a row group are in the part that holds its middle. So the number of parts says
    little unless it is several times that of the cores, and scoring a record costs far
    more than sending it."""
    cores = batch.sparkSession.sparkContext.defaultParallelism
    parts = batch.rdd.getNumPartitions()
    return batch if parts >= _PARTS_A_CORE * cores else batch.repartition(max(cores, parts))


def score_stream(records: DataFrame, bundle: Bundle | CurrentBundle, out_path: str, reject_path: str,
                 checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Scores and rejects of every micro-batch, from one reading of it. Each
    batch owns the folder of its number, which a repeated batch overwrites, so
    both sinks hold every record once. ``checkpoint`` must be in shared storage."""
    def write(batch: DataFrame, number: int) -> None:
        noted = []
        if isinstance(bundle, CurrentBundle):
            version, used = bundle.get()
            noted = [F.lit(version).alias("bundle_version")]
        else:
            used = bundle
        judged = score_records(spread(batch), used).persist()
        try:
            judged.where("accepted").select("customer_id", *OUTPUTS, *noted).write.mode("overwrite").parquet(
                f"{out_path}/batch={number}")
            judged.where("NOT accepted").select("customer_id", "reasons", *noted).write.mode("overwrite").parquet(
                f"{reject_path}/batch={number}")
        finally:
            judged.unpersist()

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()

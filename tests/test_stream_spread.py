"""A micro-batch of few files is scored by all cores."""

from keepwell.streaming.scoring import spread


def test_micro_batch_of_one_file_is_spread(spark, tmp_path):
    spark.range(1_000).coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []

    def write(batch, number):
        wide = spread(batch)
        seen.append((batch.rdd.getNumPartitions(), wide.rdd.getNumPartitions(), sorted(r["id"] for r in wide.collect())))

    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "state")).trigger(
        availableNow=True).start().awaitTermination()
    assert seen == [(1, spark.sparkContext.defaultParallelism, list(range(1_000)))]


def test_wide_batch_stays_as_it_is(spark):
    wide = spark.range(100).repartition(4 * spark.sparkContext.defaultParallelism)
    assert spread(wide) is wide


def test_parts_without_rows_do_not_count(spark, tmp_path):
    """A file of one row group in as many parts as cores: all its rows are in one."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(300_000).coalesce(1).write.parquet(str(tmp_path / "in"))
    size = max(p.stat().st_size for p in (tmp_path / "in").glob("*.parquet"))
    changed = {"spark.sql.files.openCostInBytes": "1024", "spark.sql.files.maxPartitionBytes": str(size // cores)}
    before = {k: spark.conf.get(k) for k in changed}
    seen = []

    def rows(df):
        return [n for n in df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n]

    def write(batch, number):
        seen.append((batch.rdd.getNumPartitions() >= cores, len(rows(batch)), sorted(rows(spread(batch)))))

    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "state")).trigger(
            availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [s[:2] for s in seen] == [(True, 1)]
    assert len(seen[0][2]) >= cores and sum(seen[0][2]) == 300_000 and max(seen[0][2]) < 100_000
